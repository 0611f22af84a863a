"""Long and odd texts end, in time, with whole results."""

import time

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sparkvec.llm import lattice_lm, packing


def test_packing_of_long_white_space():
    encoder, library = packing.Encoder.at(packing.VOCABULARY), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    gaps = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\xa0", "\x85", " ", "　", " \t", "\n ", "\r\n"]
    for gap in gaps:
        for n in (3, 10_001, 30_000):
            for text in (f"a{gap * n}b", f"{gap * n}x y", f"word  {gap * n}", f"a{gap * n} b{gap * n}\nc", f"{gap * n}<|endoftext|>{gap * n}1"):
                assert encoder.whole(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), (gap, n)
    start = time.time()
    for gap in (" ", "\t", "\n", "\r\n"):
        assert len(encoder.whole("a" + gap * 5_000_000 + "b")) > 8
    assert time.time() - start < 120


def test_scores_of_words_seen_once(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(("x" * 2000, "one", "two three"))], "doc_id long, text string")
    got = lattice_lm.score(df).collect()
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
