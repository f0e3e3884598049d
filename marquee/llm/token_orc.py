"""Token ids written as ORC: integer run-length encoding, row indexes and Bloom
filters on the document id, read back stripe-parallel.

Writing.  Documents are range-partitioned by id, sorted within each partition,
encoded in that order and written by Spark's ORC writer, one file for each
partition; each row carries the number of ids before it in its own file.  A
lookup by id prunes stripes and row groups by their statistics and Bloom
filters (``lookup``).

Reading.  A file's place in the whole is the sum over the files before it,
which needs one row for each file, not for each document.

White space always ends a token of the default tokenizer, so a text is cut at
blanks, tabs and line ends, each distinct piece of a batch is encoded once by the
library, and the texts' ids are put together from the pieces'.  Whether a
tokenizer has these rules is read from its definition; with any other one the
library encodes whole texts.

Cases: null and empty texts hold the end id alone; rows without an id come
first; rows that share an id stand side by side in order of their texts; an
empty table writes no rows and reads back none; other columns are not written.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CHUNK, PieceTable, array_chunks, arrow_column, broadcast_if_few, made_once

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SCHEMA = "doc_id bigint, start_in_file bigint, ids array<int>"
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(64 << 20),
    "compression": "lz4",
}
#: Distinct pieces of text whose ids a worker remembers; emptied when full.
REMEMBERED = 600_000
#: Stands between pieces that are encoded in one call: a token of its own, never part of a merge.
_MARK = "\x01"
#: A run of these after a letter or digit is always a pre-token of its own.
_TAIL = ".,!?;:*%$&#|)\""
#: The rules that let a text be cut at white space and a word's form be made here.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
          "end_of_word_suffix": "</w>", "ignore_merges": False}


def cut_at_blanks(definition: str) -> bool:
    """Whether the tokenizer has the rules by which texts may be encoded piece by piece."""
    rules = json.loads(definition)
    if any(rules.get(k) is not None for k in ("truncation", "padding")):
        return False
    # An added token is found before all rules: none may lie across blanks or within a word and its tail.
    apart = all(not any(c.isspace() for c in t["content"]) and not t["lstrip"] and not t["rstrip"]
                and any(not c.isalpha() and c not in _TAIL for c in t["content"]) for t in rules["added_tokens"])
    return (apart and rules["normalizer"] == _NORMALIZER and rules["pre_tokenizer"] == _PRE_TOKENIZER
            and {k: rules["model"].get(k) for k in _MODEL} == _MODEL)


class Encoder:
    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_str(definition)
        self.by_pieces = cut_at_blanks(definition)
        if not self.by_pieces:
            return
        self.mark = self._ids(_MARK)
        # The library's model alone, for words whose normal form is made here.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        self.table = PieceTable(self._solve, REMEMBERED)
        self.tails: dict[str, list[int]] = {"": []}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def _solve(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters, with or without signs behind, by the model alone; all others by the whole library."""
        words, tails, rest = [], [], []
        for p in pieces:
            core = p if p.isalpha() else p.rstrip(_TAIL)
            if (form := _word_form(core)) is None:
                rest.append(p)
                tails.append(None)
            else:
                words.append(form)
                tails.append(p[len(core):])
        others = self._others(rest)
        whole, cut = self._words(words)
        # The pieces' ids lie in three stores: words, tails, others; each piece is a word and a tail, or an other.
        kinds = list(dict.fromkeys(t for t in tails if t))
        stores = [whole, *[np.array(self._tail(t), dtype=np.int32) for t in kinds], *others]
        flat = np.concatenate(stores) if stores else np.zeros(0, np.int32)
        wide = np.array([*cut, *map(len, stores[1:])], dtype=np.int64)
        first = np.cumsum(wide) - wide
        at = {t: len(cut) + k for k, t in enumerate(kinds)}
        word, other, parts = 0, len(cut) + len(kinds), []
        sizes = np.ones(len(pieces), dtype=np.int64)
        for k, t in enumerate(tails):
            if t is None:
                parts.append(other)
                other += 1
            else:
                parts.append(word)
                word += 1
                if t:
                    parts.append(at[t])
                    sizes[k] = 2
        parts = np.array(parts, dtype=np.int64)
        own = wide[parts]
        ends = np.concatenate(([0], np.cumsum(own)))
        place = np.repeat(first[parts] - ends[:-1], own) + np.arange(ends[-1])
        return flat[place], np.diff(ends[np.concatenate(([0], np.cumsum(sizes)))])

    def _words(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of the words, and each word's number of them: a word's last token is a word end, and no other."""
        if not words:
            return np.zeros(0, np.int32), []
        ids = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype=np.int32)
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(words):
            raise ValueError("a word's ids don't end where the tokenizer's word ends do")
        return ids, np.diff(np.concatenate(([-1], ends))).tolist()

    def _tail(self, signs: str) -> list[int]:
        if (ids := self.tails.get(signs)) is None:
            ids = self._ids(signs).tolist()
            if len(self.tails) < 10_000:
                self.tails[signs] = ids
        return ids

    def _others(self, parts: list[str]) -> list[np.ndarray]:
        if len(self.mark) != 1 or any(_MARK in p for p in parts):
            return [self._ids(p) for p in parts]
        ids = self._ids(f" {_MARK} ".join(parts))
        cut = np.split(ids, np.flatnonzero(ids == self.mark[0])) if parts else []
        return [c[bool(k):] for k, c in enumerate(cut)]

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch in order, each text followed by the end id, and the texts' numbers of ids."""
        batch = pc.fill_null(batch, "")
        if self.by_pieces:
            self.table.make_room()
            for blank in "\n\t\r":
                batch = pc.replace_substring(batch, blank, " ")
            flat, sizes = self.table.ids_of_lists(pc.split_pattern(batch, " "))
        else:
            lists = [self._ids(t) for t in batch.to_pylist()]
            flat = np.concatenate([np.zeros(0, np.int32), *lists])
            sizes = np.array([len(x) for x in lists], dtype=np.int64)
        sizes = sizes + 1
        out = np.full(int(sizes.sum()), END_ID, dtype=np.int32)
        own = np.ones(len(out), dtype=bool)
        own[np.cumsum(sizes) - 1] = False
        out[own] = flat
        return out, sizes


def _byte_letters() -> dict[int, str]:
    """The tokenizer's letter for each byte: printable Latin-1 stands for itself, the others follow 255 in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _word_form(part: str) -> str | None:
    """What the tokenizer's normalizer and byte mapping make of a part of letters alone, which is one
    pre-token; None for any other part (the library then does all of it)."""
    if not part.isalpha():
        return None
    if part.isascii():
        return part.lower()
    # A capital sigma's lower case depends on its place in some libraries.
    form = unicodedata.normalize("NFC", part)
    if "\u03a3" in form or not (form := form.lower()).isalpha():
        return None
    return form.encode().decode("latin-1").translate(_LETTERS)


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
          tokenizer_path: str = TOKENIZER, options: dict | None = None) -> str:
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    if len(definition) > 64 << 20:
        raise ValueError(f"{tokenizer_path}: a definition of {len(definition)} characters is not broadcast")
    sent = spark.sparkContext.broadcast(definition)

    def encoded(batches):
        encoder, before = made_once("encoder", sent, Encoder), 0
        for batch in batches:
            at = 0
            for body in array_chunks(batch.column("t"), 2 * CHUNK):
                flat, sizes = encoder.encode(body)
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("i").slice(at, len(body)), pa.array(before + ends - sizes, pa.int64()), lists],
                    names=["doc_id", "start_in_file", "ids"])
                before += int(ends[-1])
                at += len(body)
            pa.default_memory_pool().release_unused()

    dealt = (docs.select(F.col(doc_id).cast("bigint").alias("i"), F.col(text).cast("string").alias("t"))
             .repartitionByRange("i").sortWithinPartitions("i", "t"))
    (dealt.mapInArrow(encoded, SCHEMA).write.options(**{**ORC_OPTIONS, **(options or {})}).orc(path))
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``doc_id, start, n_tokens, ids`` of the files; ``start`` counts the ids of all rows before."""
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("file", F.col("_metadata.file_name"))
    files = rows.groupBy("file").agg(F.max(F.col("start_in_file") + F.size("ids")).alias("n"))
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One narrow row for each file: without the broadcast all ids would be shuffled by file.
    return rows.join(broadcast_if_few(files), "file").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"),
        F.size("ids").cast("bigint").alias("n_tokens"), "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of the given documents; stripes and row groups are skipped by statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def ids_crc32(column):
    """Checksum of the ids as little-endian unsigned 32-bit integers."""

    def kernel(batch: pa.Array) -> pa.Array:
        values = batch.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(np.concatenate(([0], batch.value_lengths().to_numpy(zero_copy_only=False)))).tolist()
        return pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:], strict=False)], pa.int64())

    return arrow_column(kernel, "bigint")(column)
