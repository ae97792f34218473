"""Problem 10: made sentences with personal data, labelled as they are made.

Forms of numbers and contexts are stated as fixed values; names are drawn from those the corpus knows and from syllables, so
that the model learns to go by context where a name is unknown.  The sentences are the same for the same names.
"""

from __future__ import annotations

import random
import re

#: Forms of numbers of personal documents; 9 is a digit, A a capital.
ID_FORMS = frozenset({
    "999.999.999-99", "999 999 999 99", "999999999-99", "99999999999", "99.999.999-9", "99.999.999-A", "999-99-9999", "999 99 9999", "99999999A", "99999999-A",
    "AA-99.999.999", "AA999999", "AA9999999", "A9999999A", "A-9999999-A", "999999999", "AA999999A", "9999 9999 9999",
})
#: Forms of telephone numbers.
PHONE_FORMS = frozenset({
    "+99 99 99999-9999", "(99) 99999-9999", "(99) 9 9999-9999", "(99)999999999", "+99(99)99999 9999", "999 99999.9999", "99 99999-9999",
    "999 999 999", "+99 999-999-999", "+99 999 999 999", "(999) 999-9999", "999-999-9999", "999.999.9999", "+9 999 999 9999", "(99) 9999-9999", "+99 99 9999-9999",
    "9999 999 9999", "9999-999-9999", "99999-9999", "9999-9999", "+999 999 999 999", "+9 (999) 999-9999", "999999999",
})
#: Forms of other numbers.
OTHER_FORMS = ("999-99-99999-99-9", "9999.9999999-9", "999.999", "9999-9999", "9.999.999", "99/99/9999", "9999", "999999", "9999999-99.9999.9.99.9999", "999.9", "99.999,99", "9999/9999")
#: Words that come before each kind; ``_`` stands for the number, the name and so on.
BEFORE = {
    "id": ("CPF _", "o CPF _", "RG _", "RG nº _", "documento _", "nº do documento _", "portador do RG _", "passaporte _", "Passaporte nº _", "DNI _", "con DNI _", "NIE _", "documento de identidad _", "SSN _", "my SSN is _", "passport _", "ID number _", "identity card _", "Identidade: _", "NIF _"),
    "phone": ("Tel _", "Tel.: _", "telefone _", "Ligue para _", "ligue para o _", "WhatsApp _", "celular _", "Fone: _", "call _", "Phone: _", "call me at _", "reach us on _", "llame al _", "Teléfono: _", "móvil _", "Recado deixado em _", "contato: _"),
    "other": ("ISBN _", "ISSN _", "Protocolo _", "protocolo nº _", "lote _", "Item _", "item _", "nota _", "processo _", "Edital _", "expediente _", "batch _", "protocol _", "R$ _", "US$ _", "€ _", "em _", "de _ inscritos", "às _ horas", "questão _", "página _", "doi _", "serial _", "pedido _"),
    "name": ("Prof. _", "Profa. _", "Sr. _", "Sra. _", "Dr. _", "Dra. _", "Mr. _", "Mrs. _", "Nome: _", "Nome completo: _", "Name: _", "Nombre: _", "o aluno _", "a candidata _", "o candidato _", "a professora _", "el alumno _", "la profesora _", "the student _", "my teacher _", "Assinado: _", "Atenciosamente, _", "contato com _", "entrevista de _", "Me llamo _", "Meu nome é _", "My name is _", "segundo _", "por _", "by _", "_"),
    "place": ("em _", "de _", "na cidade de _", "in _", "near _", "en _", "cerca de _", "visita a _", "moradores de _", "vecinos de _", "para _", "Perto de _"),
    "email": ("Escreva para _", "e-mail _", "E-mail: _", "mail me at _", "escriba a _", "contato: _", "correo _"),
    "address": ("Moro na _", "mora na _", "Endereço: _", "Local: _", "mail it to _", "lives at _", "Address: _", "vive en _", "Dirección: _", "entregue na _", "voltou da _"),
}
AFTER = (".", ", obrigado.", " depois das 14h30.", " hoje", " comentou o item.", " said so.", " em nome próprio.", " y no volvió.", " na segunda.", " para confirmar.", "\n", " e a sala.", " wrote it.", " explicó el tema.")
FIRST = ("A prova foi ontem.", "O estudo comparou 37 turmas.", "The class was long.", "El examen fue fácil.", "Desde 1868,", "Na aula,", "", "", "")
STREETS = (("Rua", ""), ("R.", ""), ("Av.", ""), ("Avenida", ""), ("Travessa", ""), ("Calle", ""), ("C/", ""), ("Avda. de", ""), ("Plaza", ""), ("", "Street"), ("", "Road"), ("", "Avenue"), ("", "St"), ("", "Lane"))
INSTITUTIONS = ("Instituto", "Escola", "Colégio", "Universidade de", "Editora", "Universidad de", "School of")
PLACE_WORDS = ("Alto", "Nova", "Porto", "Vale do", "Serra do", "Lagoa do", "Barra do", "San", "New", "")
_SYLLABLES = ("ba", "be", "bor", "ca", "cor", "da", "den", "do", "fa", "fer", "ga", "gon", "ja", "ko", "kwa", "la", "lin", "lo", "ma", "men", "mi", "na", "nor", "o", "pa", "per", "qui", "ra", "ri", "sal", "san", "ta", "ti", "to", "val", "vi", "wa", "xan", "ya", "ze", "zo")


def _filled(form: str, rng: random.Random) -> str:
    return re.sub("[9A]", lambda m: rng.choice("0123456789") if m.group() == "9" else rng.choice("ABCDEFGHJKLMNPRSTVWXYZ"), form)


def _made_up(rng: random.Random) -> str:
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randrange(2, 4))).capitalize() + rng.choice(("", "", "s", "n", "ez", "ini", "mah"))


def _name(rng: random.Random, given: list[str], family: list[str]) -> str:
    known = lambda words: rng.choice(words).capitalize() if words and rng.random() < 0.6 else _made_up(rng)
    last = [known(family) for _ in range(rng.choice((1, 1, 1, 2)))]
    middle = rng.choice(("", "", "", " de", " da", " dos")) if len(last) == 1 else ""
    name = f"{known(given)}{middle} {' '.join(last)}"
    return name.upper() if rng.random() < 0.05 else name


def _address(rng: random.Random) -> str:
    before, behind = rng.choice(STREETS)
    street, number = " ".join(_made_up(rng) for _ in range(rng.choice((1, 1, 2)))), str(rng.randrange(1, 9999))
    if behind:
        return f"{number} {street} {behind}"
    return f"{before} {street}{rng.choice((', ', ' ', ', nº ', ', n. '))}{number}{rng.choice(('', '', ', apto 31', ', casa 2'))}"


def _email(rng: random.Random) -> str:
    at, dot = rng.choice((("@", "."), ("@", "."), (" [at] ", "."), ("(arroba)", " ponto "), (" at ", " dot ")))
    return f"{_made_up(rng).lower()}.{_made_up(rng).lower()}{at}{_made_up(rng).lower()}{dot}{rng.choice(('com', 'example', 'org', 'invalid'))}"


def _place(rng: random.Random) -> str:
    if rng.random() < 0.25:
        return f"{rng.choice(INSTITUTIONS)} {_made_up(rng)}"
    return f"{rng.choice(PLACE_WORDS)} {_made_up(rng)}".strip()


def sentences(n: int, given: list[str], family: list[str], seed: int = 5, ids: frozenset[str] = ID_FORMS, phones: frozenset[str] = PHONE_FORMS) -> list[tuple[str, set[tuple[int, int, str]]]]:
    """``n`` made texts with their spans (begin, end, type); some hold what only resembles personal data."""
    rng = random.Random(seed)
    known_ids, known_phones = sorted(ids), sorted(phones)
    out = []
    for _ in range(n):
        text, spans = rng.choice(FIRST), set()
        for _ in range(rng.choice((1, 2, 2, 3))):
            kind = rng.choice(("id", "phone", "other", "other", "name", "name", "place", "place", "email", "address"))
            made = {
                "id": lambda: _filled(rng.choice(known_ids), rng), "phone": lambda: _filled(rng.choice(known_phones), rng), "other": lambda: _filled(rng.choice(OTHER_FORMS), rng),
                "name": lambda: _name(rng, given, family), "place": lambda: _place(rng), "email": lambda: _email(rng), "address": lambda: _address(rng),
            }[kind]()
            lead, tail = rng.choice(BEFORE[kind]).split("_")
            text = f"{text} {lead}" if text and not text.endswith("\n") else text + lead
            if kind not in ("other", "place"):
                spans.add((len(text), len(text) + len(made), kind))
            text += made + tail + rng.choice(AFTER)
        out.append((text, spans))
    return out
