"""White space is part of what op7 encodes."""

import pytest
from made_texts import prose

from sparkvec.llm import pieces

TEXTS = [
    "Hi there\n\nnew\tline  x ",
    "\n",
    " ",
    "   ",
    "\n\n \n  a\n b",
    " a",
    "a \n",
    "a\r\nb\r\n\r\nc{\r\n",
    "one  two   three\n\n\n    four\t\tfive\x0bsix\x0c",
    "=1\n=2\n=3 =4",
    "\n" + prose(3, 40).replace(" ", "\n", 7),
    "x" * 70 + "\n" + " " * 70 + "y",
    "Ünïcödé 😀 text   with odd\x1cspace here",
    prose(1, 60),
    "",
    None,
]


@pytest.mark.parametrize("frequent", [0, 200_000])
def test_all_white_space_is_encoded_and_comes_back(spark, frequent):
    table = pieces.piece_table(spark)
    scores = {r.piece: (r.score, r.id) for r in table.where("not is_byte").collect()}
    unknown, longest = min(s for s, _ in scores.values() if s > -1e6) - 10, max(map(len, scores))
    # The best path of the whole text at once.
    want = {i: pieces.best_path(pieces.MARK + t.replace(" ", pieces.MARK), scores, longest, unknown, 3)[0] if t else [] for i, t in enumerate(TEXTS)}
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    encoded = pieces.encode(df, table, white=True)
    assert {r.doc_id: r.ids for r in encoded.collect()} == want
    assert {r.doc_id: r.text for r in pieces.decode(encoded, table, "doc_id").collect()} == {i: t for i, t in enumerate(TEXTS) if t}
    got = {r.doc_id: r for r in pieces.digest(df, table, frequent=frequent, white=True).collect()}
    assert {i: (r.n_words, r.n_pieces, r.round_trip) for i, r in got.items()} == {i: (len((t or "").encode().split()), len(want[i]), True) for i, t in enumerate(TEXTS)}


def test_marks_of_the_text_do_not_come_back(spark):
    table = pieces.piece_table(spark)
    mark = pieces.MARK
    texts = ["a b", f"a{mark}b", f"{mark}a", "a\nb", f"a\n{mark}b", f"a\n{mark}b", "a\n b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for frequent in (0, 200_000):
        got = {r.doc_id: r.round_trip for r in pieces.digest(df, table, frequent=frequent, white=True).collect()}
        assert got == {i: mark not in t for i, t in enumerate(texts)}


def test_the_query_encodes_white_space(spark, tmp_path):
    from sparkvec.llm.queries import PLANS

    texts = ["a b", "a  b", "a\nb", "a \n b"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_pieces, r.round_trip) for r in PLANS["op7_lattice_pieces"](spark, str(tmp_path)).collect()}
    assert got == {0: (2, True), 1: (3, True), 2: (3, True), 3: (4, True)}
