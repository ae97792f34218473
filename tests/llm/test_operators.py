"""Each operator against brute force, an exact round trip, a reference library or held-out labels."""

import random
import re
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from itemforge.llm import canonical, encoding, examples, language, leaks, near, personal, reading, running, scan, subjects, tokenize_bpe

SF = "/root/testdata/sf0.01"
SAMPLE = "A médica de Porto Alto ampliou a variância; já a informação não é fácil. À noite, o avô tinha 12 m² e 3 °C."


@pytest.fixture(scope="module")
def pipeline(spark):
    return spark.read.parquet(f"{SF}/pipeline.parquet").select("ID_LINHA", "TX_IDIOMA", "DESC_ENUNCIADO", "DESC_ALTER_A").toPandas().astype(object)


# 1 --------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reader():
    words = {w: 500 for w in "o menino leu sobre a taxa de juros no pátio modo entre ceticismo página".split()} | {"narrador": 900}
    triples = {}
    for w, n in words.items():
        for i in range(len(w)):
            t = f"^{w}$"[i : i + 3]
            triples[t] = triples.get(t, 0) + n
    return scan.Reader(scan.Lexicon(words, triples, sum(words.values())))


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("o menino leu so-\nbre a taxa", ["quebra"]), ("o menino leu so¬\nbre a taxa", ["quebra"]), ("o menino leu so- \n  bre a taxa", ["quebra"]), ("o narrad0r leu", ["sinal"]), ("o ceticisrno leu", ["sinal"]),
        ("o menino\nSIMULADO 2011  SIMULADO 2021\nleu", ["linha"]), ("o menino\n- 24 -\nleu", ["linha"]), ("o menino leu\n2º dia - Caderno 7 - Rosa", ["linha"]), ("taxa de juros  SIMULADO 2014", ["linha"]), ("menino\nPag1na 24\nleu", ["linha"]),
        ("o menino so-\n- 3 -\nbre a taxa", ["quebra", "linha"]), ("1. o menino;\n2. o modo.", []), ("| a | 9 |\n| --- | --- |\n| b | 7 |", []), ("guarda-chuva e bem-te-vi", []), ("$x_1 + 10$ e H2O", []), ("Caderno 3 – Azul de Porto", []), ("24", []), ("", []), (None, []),
    ],
)
def test_traces(reader, text, kinds):
    assert sorted(reader.decode(text)[0].elements()) == sorted(kinds)


def test_running_lines_of_other_forms(reader):
    for line in ("VESTIBULAR 2019 - PROVA OBJETIVA", "Exame Nacional 2021 pág. 12", "xii", "[iv]", "CADERNO AZUL", "- 7 -", "página 3 de 40", "PROVA DE MATEMÁTICA | 2º DIA", "*AB1234CD5*"):
        assert running.weight(line) >= running.ENOUGH, line
        assert reader.decode(f"o menino leu\n{line}\nsobre a taxa")[0] == {"linha": 1}
    for line in ("Texto II", "1. o menino;", "| a | 9 |", "C", "vento de Alto,", "vi-", "A CARTEIRA", "o menino leu sobre a taxa de juros"):
        assert running.weight(line) < running.ENOUGH, line
    shape = running.shape("Colégio Alfa 2021")
    assert running.running("o menino leu\nColégio Alfa 2022\nsobre a taxa") == [] and running.ENOUGH - running.RECURS > running.weight("Colégio Alfa 2022")
    open_ = "Unidade XIV 2022"
    assert running.open_shapes(f"um\n{open_}\ndois") in ({running.shape(open_)}, set()) and shape == "Aa Aa 0"


def test_lines_that_recur_are_running_lines(spark):
    texts = [f"o menino leu sobre o caso {k} da\nMATERIAL DIDÁTICO\ntaxa de juros do mês" for k in range(40)] + ["o menino leu a\nOUTRO TÍTULO\ntaxa do mês"]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string")
    lexicon = scan.fit_lexicon(df, ["t"])
    assert lexicon.shapes == {"A A"} and running.weight("MATERIAL DIDÁTICO") < running.ENOUGH
    assert {r.id_linha for r in scan.with_traces(scan.scan_traces(df, "i", ["t"], lexicon)).collect()} == set(range(41))


def test_joint_decoding(reader):
    assert reader.decode("o ceticis-\nrno leu") == ({"quebra": 1, "sinal": 1}, "o ceticismo leu")
    assert reader.decode("o narra dor leu") == ({"corte": 1}, "o narrador leu")
    assert reader.decode("leu sobreataxa de juros") == ({"junta": 2}, "leu sobre a taxa de juros")
    compound = scan.Reader(scan.Lexicon(reader.lexicon.words | {"guarda": 300, "chuva": 300}, reader.lexicon.triples, reader.lexicon.total, {"guarda-chuva": 90}))
    assert compound.decode("o guarda-\nchuva leu") == ({"quebra": 1}, "o guarda-chuva leu") and compound.decode("o guarda-chuva leu")[0] == {}
    assert reader.decode("o menino so-\n- 3 -\nbre a taxa") == ({"linha": 1, "quebra": 1}, "o menino sobre a taxa")


def test_repair(reader):
    assert reader.repair("o menino leu so-\nbre a\n- 24 -\ntaxa de jur0s") == "o menino leu sobre a taxa de juros"
    assert reader.repair("o narra dor leu sobreataxa de juros") == "o narrador leu sobre a taxa de juros"
    assert reader.repair(None) is None and reader.repair("") == ""
    assert scan.paragraphs("Texto longo da primeira linha que\ncontinua aqui.\nOutro parágrafo começa.") == "Texto longo da primeira linha que continua aqui.\nOutro parágrafo começa."
    verse = "Texto I\nvento de Alto,\nbarco sem cor,\nnoite de Serra."
    assert scan.paragraphs("Um parágrafo bem mais longo do que os versos do poema.\n" + verse).count("\n") >= 3


# 2 --------------------------------------------------------------------------------------------------------------------


def test_automaton_parses_across_words():
    text = "abracadabra"
    a = language.SuffixAutomaton(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            assert a._read(0, text[i:j]) is not None
    assert a._read(0, "zz") is None and a._read(0, "abrax") is None
    a = language.SuffixAutomaton(language._running([["o", "menino", "leu", "o", "texto"], ["a", "médica", "leu"]]))
    assert a.phrases(["o", "menino", "leu"]) == 1 and a.phrases(["a", "médica", "leu", "o", "texto"]) == 2 and a.phrases([]) == 0
    assert a.phrases(["leu", "a"]) == 2 and a.phrases(["menina"]) == 2


def test_languages_of_held_out_sentences(pipeline):
    rows = [(g, t) for g, t in zip(pipeline.TX_IDIOMA, pipeline.DESC_ENUNCIADO) if g in language.LANGUAGES and t]
    tell = language.Classifier(language.Profile(language.purged(rows[:900])))
    cases = {
        "pt": "Segundo o informe, o menino imitou a cadeia alimentar e somou muitos metros em duas semanas.",
        "en": "For the doctor, it takes time to determine the symphony, since the stage separates the costume.",
        "es": "Por eso la médica cuestionó el fonema otra vez y el niño habló de la jerga en el patio.",
    }
    for g, t in cases.items():
        assert {x for x, n, _ in tell.passages(t) if n >= 6} == {g}
    mixed = [x for x, n, c in tell.passages(" ".join(cases.values())) if n >= 6 and c > 0.9]
    assert mixed == ["pt", "en", "es"]
    assert tell.passages("") == [] and tell.passages(None) == [] and tell.passages("12 34") == [("und", 2, 0.0)]
    inside = {
        ("pt", "en"): "Na aula de hoje o professor explicou que the water cycle starts when the sun heats the sea e depois pediu um resumo aos alunos da turma.",
        ("es", "en"): "Por eso la médica dijo en clase que the results of the survey show that most of the people agree y luego pidió un resumen otra vez.",
    }
    for languages, t in inside.items():
        assert {x for x, n, _ in tell.passages(t) if n >= 6} >= set(languages)


# 3 and 6 --------------------------------------------------------------------------------------------------------------


def test_canonical_round_trip():
    form = canonical.Canonizer()
    for damage in (lambda t: unicodedata.normalize("NFD", t), lambda t: t.replace(" ", "\xa0"), lambda t: t.replace("a", "a​"), lambda t: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t), lambda t: t.replace("o", "о").replace("e", "е")):
        assert form.canonical(damage(SAMPLE)) == SAMPLE
    for stable in (SAMPLE, "Considere α = 61° e Δt = 19 s; a razão σ/μ", "A RAZÃO Σ/Μ VALE", "“мир” – aspas — e 2ª, 3º, x²", "", "AMANHÃ NÃO HAVERÁ"):
        assert form.segments(stable) == []
    assert form.canonical(None) is None and form.canonical("conﬁguração") == "configuração"


def test_every_garbled_sequence_has_a_trigger():
    fix = encoding.Repairer()
    assert all(encoding._TRIGGER.search(s) and len(s) <= fix.longest for s in encoding.garbled_table())
    text = "x" * 40 + "Ã©" + "y" * 3 + "â€“" + "z" * 60 + "Ã£"
    assert fix.spans(text) == [(40, 42, "é"), (45, 48, "–"), (108, 110, "ã")]


def test_quick_check_covers_all_of_unicode():
    form = canonical.Canonizer()
    for odd, usual in {"3 ㎏": "3 kg", "①": "1", "ⓐ": "a", "ﻻ": "لا", "ŀ": "l·", "Å": "Å", "ﬀ": "ff", "n̋": "n̋", "é": "é", "가": "가"}.items():
        assert form.canonical(odd) == usual
    for stable in ("x̄ é a média", "xʰ e 2²", "½ ou ¼", "Miloš Dvořák e Łódź", "2πr e πr² com σ/μ", "שָׁלוֹם"):
        assert form.segments(stable) == []
    for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x30000)]):
        assert unicodedata.is_normalized("NFC", form.canonical("a" + c))


@pytest.mark.parametrize("written, read", [("utf-8", "cp1250"), ("utf-8", "iso8859_2"), ("utf-8", "cp1254"), ("cp1252", "cp1250"), ("cp1252", "iso8859_7"), ("cp1252", "cp437"), ("mac_roman", "cp1252")])
def test_other_code_pages(written, read):
    fix = encoding.Repairer()
    text = "A médica ampliou a variância e a informação não é fácil; o avô tinha três pêndulos."
    garbled = "".join(encoding._decode(bytes([b]), read) or chr(b) for b in text.encode(written))
    assert garbled != text and fix.spans(garbled) and fix.restore(garbled) == text
    for right in (text, "Miloš Dvořák e Łódź na Ὀδύσσεια", "a razão σ/μ e 2πr", "d’água — e o “mundo” › fim"):
        assert fix.spans(right) == []


@pytest.mark.parametrize("written, read", [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("utf-8", "cp850"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp1251")])
def test_garbled_round_trip(written, read):
    fix = encoding.Repairer()
    text = "A médica ampliou a variância e a informação não é fácil; o avô tinha três pêndulos e uma gíria em São Porto."
    raw = text.encode(written)
    garbled = "".join(bytes([b]).decode(read, "replace") if read != "cp1252" else bytes([b]).decode("cp1252", "ignore") or chr(b) for b in raw)
    assert fix.spans(garbled) and fix.restore(garbled) == text
    part = "Correto: ação e À noite. " + garbled
    assert fix.restore(part) == "Correto: ação e À noite. " + text


def test_correct_text_is_left():
    fix = encoding.Repairer()
    for t in (SAMPLE, "AMANHÃ NÃO HAVERÁ SESSÃO", "subiu de € 64 para £ 66, segundo a Gráfica Amanhã©", "“мир” aparece", "", None, "¿Qué efecto? ¡Sí!"):
        assert fix.spans(t) == [] and fix.restore(t) == t
    assert fix.spans("Ent�o")[0][2] is None and fix.restore("Ent�o") == "Ent�o"
    twice = "ação".encode().decode("cp1252").encode().decode("cp1252")
    assert fix.restore(twice) == "ação"


# 4 and 5 --------------------------------------------------------------------------------------------------------------


def _labelled(spark, name, col):
    text = spark.read.parquet("/root/testdata/sf0.1/pipeline.parquet").selectExpr("ID_LINHA id_linha", "DESC_ENUNCIADO t").where("length(t) > 0")
    rows = text.join(spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet"), "id_linha").groupBy("id_linha").agg({"t": "first", col: "collect_set"}).orderBy("id_linha").collect()
    return [(r[1] if isinstance(r[1], str) else r[2], r[2] if isinstance(r[1], str) else r[1]) for r in rows]


def test_reading_levels_of_held_out_documents(spark):
    cut = reading.Splitter()
    docs = [(cut.words(t), g[0]) for t, g in _labelled(spark, "reading_labels", "nivel")]
    model = reading.fit_levels(docs[::2])
    assert sum(model.level(d)[0] == g for d, g in docs[1::2]) / len(docs[1::2]) > 0.97


def test_subjects_of_held_out_documents(spark):
    rows = _labelled(spark, "subject_labels", "assunto")
    model = subjects.fit_topics(spark, [r for k, r in enumerate(rows) if k % 4])
    cut, hit, said, true = reading.Splitter(), 0, 0, 0
    for t, g in rows[::4]:
        got = {s for s, _, _ in model.subjects(cut.words(t))}
        hit, said, true = hit + len(got & set(g)), said + len(got), true + len(g)
    assert hit / said > 0.93 and hit / true > 0.93
    assert [g for g in model.map if g is not None] == list(range(len(subjects.SUBJECTS))) and model.map[len(subjects.SUBJECTS) :] == [None] * subjects.SHARED


# 7 --------------------------------------------------------------------------------------------------------------------


def brute_pairs(rows, threshold):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        if len(w) >= 3:
            sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    rows, i = [], 0
    for size in (3, 4, 6, 9, 14, 25, 40, 60, 90, 150) * 4:
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(4):
            text = list(base)
            for _ in range(rng.randrange(0, max(1, size // 12) + 1)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((i, " ".join(text)))
            i += 1
    rows += [(i, rows[0][1]), (i + 1, rows[5][1].upper() + "!"), (i + 2, None), (i + 3, ""), (i + 4, "um dois")]
    df = spark.createDataFrame(rows, "i bigint, t string")
    for threshold in (0.5, 0.8):
        got = [(r.id_a, r.id_b) for r in near.alike_pairs(df, "i", "t", threshold).collect()]
        assert len(got) == len(set(got)) and set(got) == brute_pairs(rows, threshold)


def test_hot_seed_and_large_class(spark, monkeypatch):
    monkeypatch.setattr(near, "EXPAND", 5)
    shared = " ".join(f"fixo{k}" for k in range(30))
    rows = [(k, shared + " " + " ".join(f"v{k}x{j}" for j in range(10))) for k in range(60)] + [(100 + k, "copia igual de um texto que se repete") for k in range(8)]
    df = spark.createDataFrame(rows, "i bigint, t string")
    got = {(r.id_a, r.id_b) for r in near.alike_pairs(df, "i", "t", 0.5).collect()}
    assert {p for p in got if p[1] < 100} == {p for p in brute_pairs(rows[:60], 0.5)}
    assert {p for p in got if p[0] >= 100} == {(100, 100 + k) for k in range(1, 8)}
    groups = {r.id: (r.grupo, r.n_ligacoes) for r in near.record_groups(df, "i", "t", 0.5).collect()}
    assert {g for k, (g, _) in groups.items() if k < 100} == {0} and groups[103] == (100, 7)


def test_prefix_tree():
    tree, sets = near.PrefixTree(), [[1, 2, 3, 9], [1, 2], [2, 3], [7], [1, 2, 3], [1, 4, 5, 6, 9], [1, 2, 3, 9], list(range(200))]
    for m, s in enumerate(sets):
        tree.add(np.array(s, np.uint64), m)
    own = np.array([1, 2, 3, 9], np.uint64)
    want = {(m, len(s), len(set(s) & {1, 2, 3, 9})) for m, s in enumerate(sets) if len(set(s) & {1, 2, 3, 9}) >= 0.5 * len(set(s) | {1, 2, 3, 9})}
    assert set(tree.join(own, 0.5)) == want and len(want) == 5


def test_frequent_runs_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(near, "HOT_ROWS", 4)
    rng = random.Random(5)
    rows = [(k, " ".join(f"w{rng.randrange(4)}" for _ in range(rng.randrange(3, 9)))) for k in range(120)]
    got = [(r.id_a, r.id_b) for r in near.alike_pairs(spark.createDataFrame(rows, "i bigint, t string"), "i", "t", 0.5).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(rows, 0.5)


# 8 --------------------------------------------------------------------------------------------------------------------


def test_ids_equal_the_library(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").collect()]
    texts += ["<|endoftext|>", " ", "\r\n\n x", "don't I'LL", "é" * 300, "x" * 1000, "日本語🙂", "a\xa0b "]
    coder = tokenize_bpe.Encoder(tokenize_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))
    assert [coder.encode(x) for x in texts] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_give_the_text_back(text):
    ranks = tokenize_bpe.read_ranks(tokenize_bpe.DEFAULT_VOCABULARY)
    names = {v: k for k, v in ranks.items()}
    ids = tokenize_bpe.Encoder(ranks).encode(text)
    assert b"".join(names[i] for i in ids) == text.encode("utf-8", "surrogatepass")


# 9 --------------------------------------------------------------------------------------------------------------------


def _plain(t):
    t = "".join(c for c in unicodedata.normalize("NFD", t.lower()) if not unicodedata.combining(c))
    return re.findall(r"[^\W_]+", t)


def test_leaks_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/eval_items.parquet").select("item_id", "text")
    index = {}
    for r in items.collect():
        w = _plain(r.text)
        for k in range(len(w) - 11):
            index.setdefault(tuple(w[k : k + 12]), set()).add(r.item_id)
    want = set()
    for r in docs.where("text is not null").collect():
        w = _plain(r.text)
        want |= {(r.doc_id, i) for k in range(len(w) - 11) for i in index.get(tuple(w[k : k + 12]), ())}
    got = leaks.leaked_passages(docs, "doc_id", "text", items, "item_id", "text").where("palavras_seguidas >= 12").collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 0


def test_alignment_scores_edited_copies():
    coder = leaks.Words()
    a, b = coder.codes("um dois três quatro cinco seis"), coder.codes("zero UM dois tres extra quatro cinco")
    assert leaks.align(b, a) == (9, 3)
    assert leaks.align(coder.codes(""), a) == (0, 0)


def test_a_full_table_of_bits_changes_nothing(spark, monkeypatch):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/eval_items.parquet")
    found = []
    for bits in (24, 6):
        monkeypatch.setattr(leaks, "BITS", bits)
        found.append({tuple(r) for r in leaks.leaked_passages(docs, "doc_id", "text", items, "item_id", "text").collect()})
    assert found[0] == found[1] and all(r[2] >= leaks.POINTS for r in found[0])


def test_edited_copies_are_found(spark):
    """Passages of 60 words with every tenth word changed, left out or doubled: at least nine in ten score as edited copies."""
    rng = random.Random(4)
    vocabulary = [f"p{k}" for k in range(2000)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(120))) for k in range(60)]
    docs = []
    for k, t in items:
        w = t.split()[30:90]
        for j in range(rng.randrange(10), 60, 10):
            w[j] = rng.choice([rng.choice(vocabulary), "", w[j] + " " + w[j]])
        docs.append((k, " ".join(rng.choice(vocabulary) for _ in range(50)) + " " + " ".join(w) + " fim."))
    docs += [(100 + k, " ".join(rng.choice(vocabulary) for _ in range(150))) for k in range(40)]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked_passages(d, "doc_id", "text", i, "item_id", "text").where(f"pontos >= {leaks.EDITED}").collect()}
    assert len(got & {(k, k) for k in range(60)}) >= 54 and not got - {(k, k) for k in range(60)}


# 10 -------------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def finder(spark):
    return personal.Finder(personal.fit_model(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), "doc_id", "text"))


@pytest.mark.parametrize(
    "text, masked",
    [
        ("Escreva para nolan.voltdrao@belzene.example, obrigado", "Escreva para [EMAIL], obrigado"),
        ("contato: NOLAN.ZANDISTAL [AT] DRITALO.INVALID hoje", "contato: [EMAIL] hoje"),
        ("Ligue para +55 26 93535-9479 depois das 14h30", "Ligue para [PHONE] depois das 14h30"),
        ("Recado deixado em (40) 9 0336-8237 às 9h", "Recado deixado em [PHONE] às 9h"),
        ("Inscrição feita com o CPF 334.740.009-78 em nome próprio", "Inscrição feita com o CPF [ID] em nome próprio"),
        ("Moro na Av. Bramistal, nº 1404, apto 31 e a sala", "Moro na [ADDRESS] e a sala"),
        ("mail it to 1825 Felganck Street soon", "mail it to [ADDRESS] soon"),
        ("Prof. Breno Zandentim comentou o item", "Prof. [NAME] comentou o item"),
        ("Desde 1868, Gonzalo Xandutti Bramozzo sustentou", "Desde 1868, [NAME] sustentou"),
        ("O Instituto Clerorvo divulgou 29.024 inscritos", "O Instituto Clerorvo divulgou 29.024 inscritos"),
        ("Protocolo 2020.7711615-7, sala 27. ISBN 000-64-35957-11-6", "Protocolo 2020.7711615-7, sala 27. ISBN 000-64-35957-11-6"),
        ("Veja o perfil @turma_f no mural", "Veja o perfil @turma_f no mural"),
        ("A rua principal de Lagoa ficou fechada das 13h às 18h30", "A rua principal de Lagoa ficou fechada das 13h às 18h30"),
        ("Item 353177, lote 7842-2187, nota 721,9", "Item 353177, lote 7842-2187, nota 721,9"),
        ("Conversei com Kwame Nkrumah ontem.", "Conversei com [NAME] ontem."), ("Tel 0800 123 4567", "Tel [PHONE]"), ("Passaporte FN123456", "Passaporte [ID]"), ("RG MG-12.345.678", "RG [ID]"), ("My SSN is 123456789", "My SSN is [ID]"),
        ("", ""), (None, None),
    ],
)
def test_personal_data(finder, text, masked):
    assert finder.masked(text) == masked


def test_held_out_forms_and_names():
    """Trained without some forms of numbers and without any known name, the model finds nine in ten of what it never saw."""
    held_ids = frozenset({"999-99-9999", "AA-99.999.999", "99999999A"})
    held_phones = frozenset({"+99 99 9999-9999", "999.999.9999", "(99) 99999-9999"})
    names = personal.Names({}, {})
    made = examples.sentences(2400, [], [], ids=examples.ID_FORMS - held_ids, phones=examples.PHONE_FORMS - held_phones)
    find = personal.Finder((names, personal.fit_weights(made, names)))
    found, wanted, got = 0, 0, 0
    for text, spans in examples.sentences(1500, [], [], seed=77, ids=held_ids, phones=held_phones):
        out = set(find.spans(text))
        found, wanted, got = found + len(out & spans), wanted + len(spans), got + len(out)
    assert found >= 0.9 * wanted and found >= 0.9 * got, (found, wanted, got)


def test_forward_and_backward_sums_agree_with_all_sets():
    import itertools
    import math

    spans, scores = [(0, 3, "a"), (2, 5, "b"), (5, 8, "c"), (0, 8, "d"), (3, 5, "e")], [0.3, -0.2, 1.0, 0.7, -1.0]
    sets = [s for n in range(6) for s in itertools.combinations(range(5), n) if all(spans[i][1] <= spans[j][0] or spans[j][1] <= spans[i][0] for i, j in itertools.combinations(s, 2))]
    total = sum(math.exp(sum(scores[i] for i in s)) for s in sets)
    z, p = personal.marginals(*personal.lattice(spans), scores)
    assert abs(z - math.log(total)) < 1e-9
    assert all(abs(p[i] - sum(math.exp(sum(scores[j] for j in s)) for s in sets if i in s) / total) < 1e-9 for i in range(5))


def test_decode_is_the_best_choice():
    spans = [(0, 5, "a"), (3, 8, "b"), (5, 9, "c"), (8, 12, "d")]
    assert personal.decode(spans, [2.0, 3.0, 2.0, 0.5]) == [0, 2] and personal.decode(spans, [-1.0] * 4) == [] and personal.decode([], []) == []
