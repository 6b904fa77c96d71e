"""Texts that hold an added token of the tokenizers file."""

import zlib

import corpus_pipeline
import numpy as np

from trialweave.llm import packing

TEXTS = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  \n<|endoftext|>\n  y", "<|endoftext|", "plain words", " <|endoftext|>don't" * 400, ""]


def test_ids_are_those_of_the_library(spark, tmp_path):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path(packing.TOKENIZER))
    assert tok.encode(TEXTS[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    want = []
    for i, t in enumerate(TEXTS):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want += [(i, s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes()), len(ids)) for s in range(0, len(ids), 1024)]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for out in (packing.op7_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, "")):
        assert sorted(tuple(r) for r in out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()) == want
