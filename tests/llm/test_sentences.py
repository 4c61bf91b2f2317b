"""Sentence units: hand-made cases, and properties that hold for any text."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vestigo.llm.sentences import sentence_spans, split_sentences

CASES = {
    "abbreviation": ["Dr. Quill met Ms. A. B. Orr at 3 p.m. yesterday.", "They left, cf. p. 12."],
    "company": ["Packs came from Orrin Inc.", "The next batch is late."],
    "etc": ["We saw cats, dogs, etc.", "Nothing else moved."],
    "number": ["It rose by 3.5 % to 12.", "Then it fell."],
    "version": ["Version 2.10.4 of app.exe at https://a.example/x.html?v=1.2 failed.", "Why?"],
    "dots": ["The queue drained ... and filled again.", "Nobody answered…", "We left."],
    "quote_inside": ["“We lost it!” was all she wrote.", "He asked, “Is it gone?”", "Nobody knew."],
    "bracket": ["(The export had the same hole.)", "We saw it."],
    "initialism": ["The U.S. East gateway answered.", "Fine."],
    "german": ["Der 2. Versuch am 3. März dauerte ca. 5,5 s.", "Das gilt z. B. für Abs. 2 usw.", "„Bitte warten!“, sagte er."],
    "french": ["Le débit a doublé !", "« Pourquoi ? » a demandé M. Leroux.", "La note dit : « Non. »"],
    "spanish": ["¿Quién abrió la pág. 4?", "¡Ud. no!", "«¿Quién?», preguntó la Sra. Vela."],
    "russian": ["А. Б. Вель сравнил камеры, принтеры и т. д.", "В 2026 г. правило сработало, т. е. помогло.", "«Стой!» — крикнул он."],
    "hindi": ["डॉ. वेल ने देखा।", "नियम चला!"],
    "arabic": ["«من فتح؟» سأل د. فلمار.", "لماذا؟"],
}
JOINED = {
    "先清空……然后又满了。值班员问：“谁打开了？”“先走，”他说，“再来。”真的吗？！": ["先清空……然后又满了。", "值班员问：“谁打开了？”", "“先走，”他说，“再来。”", "真的吗？！"],
    "「再起動しないで。」と書いた。比率は3.5％だった。": ["「再起動しないで。」と書いた。", "比率は3.5％だった。"],
    "“재시작하지 마세요.”라고 적었다. 왜?": ["“재시작하지 마세요.”라고 적었다.", "왜?"],
    "It is done.The next one starts.": ["It is done.", "The next one starts."],
    "Head line\n\nFirst line\nwrapped here. Second.\n \n- item one\n- item two\n1. first\n2. second": ["Head line", "First line\nwrapped here.", "Second.", "- item one", "- item two\n1. first\n2. second"],
    "ระบบทำงาน edge-3 เมื่อคืน ผู้ดูแลตรวจสอบ": ["ระบบทำงาน edge-3 เมื่อคืน", "ผู้ดูแลตรวจสอบ"],
}
JOINED["Head line\n\nFirst line\nwrapped here. Second.\n \n- item one.\n- item two.\n1. First.\n2. Second."] = ["Head line", "First line\nwrapped here.", "Second.", "- item one.", "- item two.", "1. First.", "2. Second."]
del JOINED["Head line\n\nFirst line\nwrapped here. Second.\n \n- item one\n- item two\n1. first\n2. second"]


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("blank", [" ", "  ", " ", "\n"])
def test_cases(name, blank):
    units = [u if blank != "\n" else u for u in CASES[name]]
    text = blank.join(units)
    assert [text[a:b] for a, b in sentence_spans(text)] == units


@pytest.mark.parametrize("text", JOINED)
def test_joined(text):
    assert [text[a:b] for a, b in sentence_spans(text)] == JOINED[text]


PIECES = st.lists(st.sampled_from(list("aB1.!?…“”«»()。 \n\t -ก,") + ["Dr. ", "\n\n", "z. B. ", "Inc. ", "3. ", "「", "」"]), max_size=60).map("".join)


@given(PIECES | st.text(max_size=80))
@settings(max_examples=600, deadline=None)
def test_units_cover_everything_but_white_space(text):
    spans = sentence_spans(text)
    assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in spans)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    inside = set()
    for a, b in spans:
        inside.update(range(a, b))
    assert all(i in inside or c.isspace() for i, c in enumerate(text))
    assert all("\n\n" not in text[a:b] for a, b in spans)


def test_split_on_the_cluster(spark):
    rows = [(1, "One. Two."), (2, None), (3, ""), (4, " \n\t"), (1, "One. Two."), (None, "x"), (5, "a.m. " * 4_000), (6, "“" * 5_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start_char int")
    got = split_sentences(df).collect()
    assert sorted((r.start_char, r.end_char) for r in got if r.doc_id == 1) == [(0, 4), (0, 4), (5, 9), (5, 9)]
    assert not [r for r in got if r.doc_id in (2, 3, 4)] and [r for r in got if r.doc_id is None]
    assert split_sentences(df.limit(0)).count() == 0


def test_unit_counts_cover_every_doc_type(spark, tmp_path):
    from vestigo.llm.queries import REGISTRY

    text = "It is done. The next one starts.\n\nkind: state | relation: x"
    kinds = ["projection", "rawlog", "note", "report", "question", None]
    docs = [(k, text, kind) for k, kind in enumerate(kinds)] + [(10, " ", "rawlog"), (11, None, "projection")]
    spark.createDataFrame(docs, "doc_id long, text string, doc_type string").write.parquet(f"{tmp_path}/documents.parquet")
    spans = sentence_spans(text)
    want = (len(spans), max(e - s for s, e in spans))
    got = REGISTRY.fns["p9_unit_counts"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.units, r.longest_unit) for r in got} == dict.fromkeys(range(len(kinds)), want) and want[0] == 3


def test_long_quotations_hold_together():
    inside = "We lost the export and nobody knew why. " * 30
    text = f"The note said “{inside.strip()}” and then it stopped. The end came."
    assert [text[a:b] for a, b in sentence_spans(text)] == [text[: -len(" The end came.")], "The end came."]
    text = f"It failed ({inside.strip()}) once more. Fine."
    assert [text[a:b] for a, b in sentence_spans(text)][-1] == "Fine." and len(sentence_spans(text)) == 2
    deep = "(" * 20_000 + "a. B" + ")" * 20_000 + " c. " + "“ x. Y" * 20_000
    assert sentence_spans(deep)[-1][1] == len(deep)
