import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc
import pytest
from tokenizers import Tokenizer

from marquee.llm import token_orc
from marquee.llm.queries import op10_token_orc


def expected(texts):
    library = Tokenizer.from_file(token_orc.TOKENIZER)
    return [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_query_as_the_library(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    start, want = 0, {}
    for r, ids in zip(rows, expected([r["text"] for r in rows]), strict=True):
        want[r["doc_id"]] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in op10_token_orc(spark, "/root/testdata/sf0.01").collect()}
    assert got == want


def test_pieces_are_encoded_as_the_whole():
    with open(token_orc.TOKENIZER, encoding="utf-8") as f:
        encoder = token_orc.Encoder(f.read())
    texts = ["", " ", "It's  A\ttest\r\nof Ünïcode é ́x y z", "a<|endoftext|>b 123 ...!!",
             "x" * 3000, "日本語\n🙂🙂 'll 've", "\x1c\x85  a\x0bb\x0cc ΣΑΣ İ"]
    ids, sizes = encoder.encode(pa.array([*texts, None], pa.string()))
    texts.append(None)
    want = expected(texts)
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("change", ["no normalizer", "whole text", "added word", "truncation", "none"])
def test_other_definitions_are_encoded_by_the_library(change):
    with open(token_orc.TOKENIZER, encoding="utf-8") as f:
        rules = json.load(f)
    if change == "no normalizer":
        rules["normalizer"] = None
    elif change == "whole text":
        rules["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    elif change == "added word":
        rules["added_tokens"].append({**rules["added_tokens"][0], "id": 49408, "content": "two words", "special": False})
    elif change == "truncation":
        rules["truncation"] = {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}
    definition = json.dumps(rules)
    assert token_orc.cut_at_blanks(definition) == (change == "none")
    texts = ["Here ARE two words, and Two words.", "", None, "It's\tÜber\n123 <|endoftext|> end"]
    ids, sizes = token_orc.Encoder(definition).encode(pa.array(texts, pa.string()))
    library = Tokenizer.from_str(definition)
    want = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_files_are_in_order_and_prunable(spark, scratch):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(5000)], "doc_id bigint, text string")
    path = token_orc.write(docs.repartition(7), scratch + "/orc", options={"orc.row.index.stride": "1000"})
    got = token_orc.read(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == list(range(5000))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert [r["doc_id"] for r in token_orc.lookup(spark, path, [4321]).collect()] == [4321]
    files = spark.read.orc(path).inputFiles()
    assert all(pyarrow.orc.ORCFile(f.replace("file:", "")).nstripes >= 1 for f in files)


def test_odd_tables(spark, odd_docs, no_docs, scratch):
    got = token_orc.read(spark, token_orc.write(odd_docs, scratch + "/odd")).collect()
    assert len(got) == odd_docs.count()
    assert sorted(r["n_tokens"] for r in got)[:3] == [1, 1, 1]
    assert {r["start"] for r in got if r["doc_id"] is None} == {0}
    assert token_orc.read(spark, token_orc.write(no_docs, scratch + "/none")).count() == 0
