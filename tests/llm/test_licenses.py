"""The licence scan against plain versions."""

import re

from made_texts import prose

from sparkvec.llm import licenses

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
MIT = next(n.text for n in licenses.NOTICES if n.label == "mit" and n.keys)
GPL = next(n.text for n in licenses.NOTICES if n.label == "gpl" and n.keys)


def plain(text):
    """The contract's base columns, by its own pattern."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = {
    1: "Released under the MIT License. And the mit--LICENSE, the Apache\nLicense; CC BY; CC BY-NC 4.0",
    2: "gnu general public gnu general public license license",
    3: "MİT license mit lıcense Kk Müt license mit licensé",
    4: prose(4, 200) + " " + MIT + " " + prose(5, 100),
    5: prose(4, 50) + " " + MIT.replace("publish, ", "").replace("this software", "our fine little software") + " " + prose(5, 20),
    6: " ".join(reversed(MIT.split())),
    7: MIT.replace("free of charge", "for a fee"),
    8: "mit",
    9: "license mit cc gnu apache license",
    10: GPL.upper(),
    11: "cc " * 20_000 + "by",
    12: "mit license " * 5000,
    13: "CC0 1.0 Universal; Mozilla Public License 2.0; GNU Lesser General Public License",
}


def test_base_columns_and_labels(spark, odd_docs, no_docs):
    texts = TEXTS | {100 + r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "'x' as words", "1 as label", "2 as row", "'y' as start")
    got = {r.doc_id: r for r in licenses.summary(df).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(t), i
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
    assert got[1].labels == "apache,cc-by,cc-by-nc,mit"
    assert got[4].labels == "mit" and got[4].score == 1 and got[4].n_base == 0
    assert got[5].labels == "mit" and 0.6 <= got[5].score < 1
    assert all(got[i].labels == "" and got[i].score == 0 for i in (6, 7, 8, 102, 103, 104, 108))
    assert got[10].labels == "gpl" and got[12].n_base == 5000
    assert got[13].labels == "cc0,lgpl,mpl"
    odd = licenses.summary(odd_docs).collect()
    assert len(odd) == 10 and all(r.labels == "" for r in odd)
    assert licenses.summary(no_docs).collect() == []


def test_found_places(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.found] for r in licenses.find(df).collect()}
    assert got[2] == [(3, "gpl", True, 1.0)]
    assert [x[:2] for x in got[4]] == [(202, "mit")]
    assert got[6] == [] and [x[0] for x in got[12]] == list(range(0, 10_000, 2))


def test_other_notices(spark):
    mine = (licenses.Notice("own", "the party licence of mars"), licenses.Notice("cc-by", "cc by", base=True))
    df = spark.createDataFrame([(1, "under The Party-Licence of Mars"), (2, "mit license cc by")], "name long, body string")
    got = {r.doc_id: r.labels for r in licenses.summary(df, mine, "name", "body").collect()}
    assert got == {1: "own", 2: "cc-by"}
