"""Sentences of a text in its undamaged form, shared by the classifiers."""

from __future__ import annotations

import re

from itemforge.llm.canonical import Canonizer
from itemforge.llm.scan import join_broken, strip_running

_WRAPPED = re.compile(r"[ \t]*\n[ \t]*(?=[a-zà-ÿ])")
#: Ends of sentences and lines: the sign first, then what must stand before and behind it.
_END = re.compile(
    r"[.!?…\n](?:(?<=\n)\n*|(?<=[^\W\d_][^\W_][.!?…])[.!?…]*(?=\s|[”\"']|$)|(?<=\d\.)(?=\s+[A-ZÀ-Ý“¿¡])|(?<=[\w%°²³€][.!?…])[.!?…]*(?=\s+[A-ZÀ-Ý“¿¡]|\s*$))"
)
_WORD = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*")


class Splitter:
    """Splits texts; built once in each task."""

    def __init__(self) -> None:
        self.form = Canonizer()

    def split(self, text: str | None) -> list[str]:
        """Sentences with at least one word; null and empty texts have none."""
        return [s for s in self._parts(text) if _WORD.search(s)]

    def _parts(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not text.isascii():
            text = self.form.canonical(self.form.garbled.restore(text))
        text = strip_running(text)
        if "\n" in text:
            text = _WRAPPED.sub(" ", join_broken(text))
        return _END.split(text)

    def words(self, text: str | None) -> list[list[str]]:
        """Lower-case words of each sentence."""
        return [w for s in self._parts(text) if (w := _WORD.findall(s.lower()))]
