"""Token ids of a corpus as raw binary shards, found by key in constant time.

A shard is one file:

* the ids of its documents, little-endian unsigned integers of 2 bytes, or of 4
  for vocabularies of more than 65,536 ids, one after the other, and the end id
  0 after each document. Nothing stands between them, so the part before the
  footer is one array to map into memory;
* a footer: the documents' keys (8 bytes each), whether they have one (1), and
  their lengths with the end id (8);
* a trailer: 8 bytes of magic, then the width of an id, the number of the shard
  and the number of its documents (8 each), and one more 0 as wide as an id.

Files come from Spark's own writer, whose commit protocol admits each shard
once, whatever tasks are lost: a document is a record, and 0 parts records.
"""

from __future__ import annotations

import json
import os
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem, FileSelector
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..sources.scratch import stage
from .common import spread_join
from .perfect import PerfectHash, mixed

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks have the cores

MAGIC = b"LASTRO01"
_TRAILER = "<8sQQQ"
#: Bytes of text, and documents, of an average shard; a reader holds a shard.
SHARD_BYTES, SHARD_ROWS = 16 << 20, 1_000_000
#: Keys of one part of the index, on average.
PART_KEYS = 50_000
#: Chunks whose ids a worker remembers, in columns of some thirty bytes each, and
#: their greatest length.
CHUNKS_KEPT, LONG_CHUNK = 800_000, 64
#: Bytes of texts, and unknown words, that are encoded together.
GROUP, TOGETHER = 2_000_000, 1000
#: Whether characters of two bytes, by their number, are letters.
_LETTERS = np.array([chr(c).isalpha() for c in range(0x800)])
#: Blanks besides the space and the line feed.
_RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_RARE_ASCII = [c for c in _RARE if c.isascii()]
#: Blanks beside blanks, but for two line ends between other characters: there
#: a text is not cut into chunks.
_TOGETHER = re.compile(r"\s(?:(?<!\n)\s|[^\S\n]|\n\n|\n\Z)")
_SLOT = np.dtype([("shard", "<u4"), ("rows", "<u4"), ("offset", "<u8"), ("length", "<u8")])


class Encoder:
    """The ids that the tokenizers library gives whole texts.

    A byte-level vocabulary splits texts before it merges, and always before a
    blank or a line end that follows a character and precedes another, after a
    line end, and between a letter and an ASCII character that is none. So a
    text's ids are those of its chunks between such places, which repeat: those
    of a group of texts are told apart in columns, each is looked up once, and
    a worker remembers them. Other vocabularies, and texts with blanks beside
    blanks or with special tokens, are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"] or {}
        self.in_chunks = (
            not spec["normalizer"] and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex", True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"]
                        or re.search(r"\s", t["content"]) for t in spec["added_tokens"]))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.blank = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.blank[number] = token.startswith("\u0120")  # the blank of byte levels
        self.known = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.used, self.turn = np.zeros(0, np.int64), 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, without an end id, as bytes."""
        return [ids for part in self.encode_array(pa.array(texts, pa.large_string()))
                for ids in part.to_pylist()]

    def encode_array(self, texts: pa.Array) -> Iterator[pa.Array]:
        """The same of a column without NULLs, some texts at a time."""
        texts = texts.cast(pa.large_string())
        sizes = pc.binary_length(texts).to_numpy()
        groups = (np.cumsum(sizes) - sizes) // GROUP
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
        for s, e in zip(cuts, cuts[1:]):
            if s < e:
                yield self._group(texts.slice(s, e - s))

    def _cut(self, text: str) -> bool:
        """Whether a text's chunks have the ids they have in it."""
        if not self.in_chunks or any(token in text for token in self.special):
            return False
        if any(blank in text for blank in (_RARE_ASCII if text.isascii() else _RARE)):
            return not _TOGETHER.search(text)
        return not ("  " in text or " \n" in text or "\n " in text or "\n\n\n" in text
                    or text.endswith("\n\n"))

    def _chunks(self, texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
        """All chunks, and the number of the first of each text, then of chunks."""
        at = np.frombuffer(texts.buffers()[1], np.int64)[
            texts.offset:texts.offset + len(texts) + 1]
        if at[0] == at[-1]:
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
        held = texts.buffers()[2].slice(at[0], at[-1] - at[0])
        at = at - at[0]
        data = np.frombuffer(held, np.uint8)
        line = data == ord("\n")
        letter = (data | 32) - np.uint8(ord("a")) < 26
        begins = line | (data == ord(" "))
        other = (data < 128) & ~letter
        begins[1:] |= line[:-1] | (letter[:-1] & other[1:])
        after = np.flatnonzero(other[2:] & (data[1:-1] >= 128) & (data[:-2] >= 0xC0)) + 2
        begins[after] |= _LETTERS[(data[after - 2] & 31).astype(int) << 6 | data[after - 1] & 63]
        for text, s, e in zip(texts.to_pylist(), at.tolist(), at[1:].tolist()):
            if not self._cut(text):
                begins[s:e] = False
        begins[at[:-1][at[:-1] < at[1:]]] = True
        starts = np.flatnonzero(begins)
        chunks = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data))), held)
        return chunks, np.searchsorted(starts, at)

    def _group(self, texts: pa.LargeStringArray) -> pa.Array:
        chunks, firsts = self._chunks(texts)
        own = chunks.dictionary_encode()
        at = self._places(own.dictionary)[own.indices.to_numpy()]
        # chunks follow one another, so their ids do, and a text's have no gaps
        ends = np.append(0, np.cumsum(pc.binary_length(self.ids).to_numpy()[at]))
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [
            None, pa.py_buffer(ends[firsts]), self.ids.take(pa.array(at)).buffers()[2]])
        self._forget()
        return found

    def _places(self, chunks: pa.LargeStringArray) -> np.ndarray:
        """Where in ``known`` and ``ids`` distinct chunks are, from now on."""
        # the few are hashed, and the many that are known looked up among them
        found = pc.index_in(self.known, value_set=chunks)
        here = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        at = np.full(len(chunks), -1)
        at[found.drop_null().to_numpy()] = here
        missing = np.flatnonzero(at < 0)
        at[missing] = len(self.known) + np.arange(len(missing))
        new = chunks.take(pa.array(missing))
        # by numpy, as to_pylist makes a scalar of each
        learnt = self._learn(new.to_numpy(zero_copy_only=False).tolist())
        self.known = pa.concat_arrays([self.known, new])
        self.ids = pa.concat_arrays([self.ids, pa.array(learnt, pa.large_binary())])
        self.used = np.append(self.used, np.zeros(len(new), np.int64))
        self.turn += 1
        self.used[at] = self.turn
        return at

    def _forget(self) -> None:
        """Very long chunks, and of too many the half not used for longest."""
        keep = np.flatnonzero(pc.binary_length(self.known).to_numpy() <= LONG_CHUNK)
        if len(keep) > CHUNKS_KEPT:
            keep = keep[np.argsort(-self.used[keep], kind="stable")[:CHUNKS_KEPT // 2]]
        if len(keep) < len(self.known):
            self.known, self.ids = self.known.take(keep), self.ids.take(keep)
            self.used = self.used[keep]

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that are not known."""
        words = [c for c in chunks if c[0] == " " and c[1:].isalpha()]
        found = dict(self._words(words))
        others = [c for c in chunks if c not in found]
        found.update(zip(others, self._library(others)))
        return list(map(found.__getitem__, chunks))

    def _words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters after a blank, many in one text: a word's ids begin
        with the one that holds its blank, and no other does."""
        width = self.kind.itemsize
        for k in range(0, len(words), TOGETHER):
            part = words[k:k + TOGETHER]
            encoding = self.tokenizer.encode_batch_fast(
                ["".join(part)], add_special_tokens=False)[0]
            ids = np.array(encoding.ids, self.kind)
            starts = (np.flatnonzero(self.blank[ids]) * width).tolist()
            data = ids.tobytes()
            yield from zip(part, (data[s:e] for s, e in
                                  zip(starts, [*starts[1:], len(data)])), strict=True)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array(self.kind.char, e.ids).tobytes() for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The vocabulary at ``path``, which exists on every machine, once a process."""
    return Encoder(path)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, batches of short texts put together up to a group."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > GROUP:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _records(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        keys, known, lengths = [], [], []
        for batch in _joined(batches):
            key = batch.column(0)
            known.append(key.is_valid().to_numpy(zero_copy_only=False))
            keys.append(key.fill_null(0).to_numpy(zero_copy_only=False))
            for records in own.encode_array(batch.column(1)):
                lengths.append(pc.binary_length(records).to_numpy() // own.kind.itemsize + 1)
                yield pa.RecordBatch.from_arrays([records.cast(pa.binary())], ["record"])
        count = sum(map(len, keys))
        if count:
            footer = b"".join(
                np.concatenate(parts).astype(kind).tobytes() for parts, kind in
                ((keys, "<i8"), (known, "u1"), (lengths, "<i8")))
            trailer = struct.pack(_TRAILER, MAGIC, own.kind.itemsize,
                                    TaskContext.get().partitionId(), count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([footer + trailer], pa.binary())], ["record"])
    return run


class Shard:
    """One file's ids and documents, parsed from its bytes."""

    def __init__(self, data):
        data = memoryview(data)
        for width in (2, 4):
            at = len(data) - width - struct.calcsize(_TRAILER)
            if at >= 0 and bytes(data[at:at + 8]) == MAGIC:
                _, own, self.number, count = struct.unpack_from(_TRAILER, data, at)
                if own == width:
                    break
        else:
            raise ValueError("not a whole shard")
        lengths = at - 8 * count
        self.lengths = np.frombuffer(data, "<i8", count, lengths)
        self.known = np.frombuffer(data, "u1", count, lengths - count).astype(bool)
        self.keys = np.frombuffer(data, "<i8", count, lengths - 9 * count)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.ids = np.frombuffer(data, f"<u{width}", int(self.lengths.sum()))
        if self.ids.nbytes != lengths - 9 * count:
            raise ValueError("not a whole shard")


_ENTRY = ("shard long, place long, key long, offset long, n_tokens long, "
          "ids_crc32 long, width int")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            shard = Shard(content.as_buffer())
            wide = memoryview(shard.ids.astype("<u4")).cast("B")
            ends = 4 * (shard.offsets + shard.lengths)
            sums = [crc32(wide[s:e]) for s, e in zip((4 * shard.offsets).tolist(),
                                                     ends.tolist())]
            count = len(shard.keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, shard.number, np.int64)), pa.array(np.arange(count)),
                 pa.array(shard.keys, pa.int64(), mask=~shard.known),
                 pa.array(shard.offsets), pa.array(shard.lengths), pa.array(sums, pa.int64()),
                 pa.array(np.full(count, shard.ids.itemsize, np.int32))],
                [c.split()[0] for c in _ENTRY.split(", ")])


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(key, 999) % np.uint64(parts)).astype(np.int64)


def _with_parts(parts: int):
    """Adds, as the last column, the part of the index that a key is in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(_part(key, parts))], [*batch.schema.names, "part"])
    return run


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a part, from rows sorted by part: its index and its slots."""
    names, held = ("part", "key", "shard", "rows", "offset", "n_tokens"), None

    def done(rows: dict) -> pa.RecordBatch:
        index = PerfectHash.of(rows["key"])
        slots = np.zeros(len(rows["key"]), _SLOT)
        at = index.numbers(rows["key"])
        for name, column in zip(_SLOT.names, ("shard", "rows", "offset", "n_tokens")):
            slots[name][at] = rows[column]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["part"][:1]), pa.array([index.to_bytes()], pa.binary()),
             pa.array([slots.tobytes()], pa.binary())], ["part", "index", "slots"])
    for batch in batches:
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        if held:
            rows = {n: np.concatenate([held[n], rows[n]]) for n in names}
        cuts = [0, *(np.flatnonzero(np.diff(rows["part"])) + 1)]
        for s, e in zip(cuts, cuts[1:]):
            yield done({n: x[s:e] for n, x in rows.items()})
        held = {n: x[cuts[-1]:] for n, x in rows.items()}
    if held and len(held["part"]):
        yield done(held)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, shard, offset, n_tokens, rows) of the keys that follow their part."""
    part, index, slots = None, None, None
    for batch in batches:
        parts = batch.column("part").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(parts)]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            rows = batch.slice(s, e - s)
            if parts[s] != part:
                part, index = parts[s], None
            given = rows.column("index").is_valid().to_numpy(zero_copy_only=False)
            if given[0]:
                index = PerfectHash.from_bytes(rows.column("index")[0].as_py())
                slots = np.frombuffer(rows.column("slots")[0].as_py(), _SLOT)
            if index is None:
                continue
            keys = rows.column("key").filter(pa.array(~given)).to_numpy(
                zero_copy_only=False).astype(np.int64)
            at = index.find(keys)
            keys, found = keys[at >= 0], slots[at[at >= 0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), *(pa.array(found[n].astype(np.int64)) for n in
                                   ("shard", "offset", "length", "rows"))],
                ["key", "shard", "offset", "n_tokens", "rows"])


class TokenStore:
    """A corpus of token ids below ``folder``: ids, entries, shards and index."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @classmethod
    def write(cls, docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id",
              text_col: str = "text", shard_bytes: int = SHARD_BYTES,
              shard_rows: int = SHARD_ROWS, part_keys: int = PART_KEYS) -> TokenStore:
        """Encode ``docs`` into shards in ascending order of their ids.

        Documents are range-partitioned by (id, hash of the text, place), so
        that an id of many rows has several shards, and each partition becomes
        a shard: as many as there are ``shard_bytes`` of text, or ``shard_rows``
        documents. A writer holds a batch of texts and the footer. Shards vary
        with the lengths of texts; readers hold one, so it must stay below 2 GB.

        NULL and empty texts have the end id only. Documents without an id come
        last and are in no index. Rows that share an id follow one another, by a
        hash of their text; the index leads to the first and tells their number.
        Other columns are ignored. An empty table has no shards.
        """
        spark = docs.sparkSession
        store = cls(spark, folder)
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.select(F.col(id_col).cast("long").alias("key"), text.alias("text"))
        size, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
        order = [F.col("key").asc_nulls_last(), F.col("hash"), F.col("place")]
        shards = max(1, -(-(size or 0) // shard_bytes), -(-count // shard_rows))
        records = (rows.withColumns({"hash": F.xxhash64("text"),
                                     "place": F.monotonically_increasing_id()})
                   .repartitionByRange(shards, *order).sortWithinPartitions(*order)
                   .select("key", "text").mapInArrow(_records(tokenizer), "record binary"))
        end = "\0" * encoder(tokenizer).kind.itemsize
        records.select(F.col("record").cast("string")).write.option(
            "lineSep", end).text(f"{store.folder}/ids")
        store._describe(part_keys)
        return store

    def _describe(self, part_keys: int) -> None:
        """Read the shards once and write what is in them, and the index."""
        files = self.spark.read.format("binaryFile").load(f"{self.folder}/ids")
        entries = stage(files.select("content").mapInArrow(_entries, _ENTRY),
                        "entries", f"{self.folder}/entries")
        # one row a shard: tens of thousands for a terabyte of text
        totals = entries.groupBy("shard").agg(
            F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"),
            F.max("width").alias("width"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        stage(totals.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))),
              "shards", f"{self.folder}/shards")
        keyed = (entries.where("key IS NOT NULL").groupBy("key")
                 .agg(F.min(F.struct("shard", "place", "offset", "n_tokens")).alias("first"),
                      F.count("*").alias("rows"))
                 .select("key", "first.shard", "rows", "first.offset", "first.n_tokens"))
        parts = max(1, -(-entries.count() // part_keys))
        schema = "key long, shard long, rows long, offset long, n_tokens long, part long"
        stage(keyed.mapInArrow(_with_parts(parts), schema)
              .repartition("part").sortWithinPartitions("part")
              .mapInArrow(_indexed, "part long, index binary, slots binary")
              .withColumn("parts", F.lit(parts)), "index", f"{self.folder}/index")

    def entries(self) -> DataFrame:
        """What the files hold, a row a document: shard, place (in the shard),
        key, offset (ids before it in the shard), n_tokens, ids_crc32."""
        return self.spark.read.parquet(f"{self.folder}/entries").drop("width")

    def shards(self) -> DataFrame:
        """(shard, docs, tokens, width, start): start is of ids before the shard."""
        return self.spark.read.parquet(f"{self.folder}/shards")

    def locate(self, keys: DataFrame, key_col: str = "key") -> DataFrame:
        """(key, shard, offset, n_tokens, rows, start) of the ``keys`` in the store.

        Keys are shuffled to their part of the index, once each, and looked up
        as they stream by; unknown and NULL keys give no row.
        """
        index = self.spark.read.parquet(f"{self.folder}/index")
        parts = (index.agg(F.max("parts")).first()[0]) or 1
        asked = (keys.select(F.col(key_col).cast("long").alias("key"))
                 .where("key IS NOT NULL").distinct()
                 .mapInArrow(_with_parts(parts), "key long, part long"))
        both = index.select("part", F.lit(None).cast("long").alias("key"), "index",
                            "slots").unionByName(asked, allowMissingColumns=True)
        found = (both.repartition("part")
                 .sortWithinPartitions("part", F.col("index").isNull())
                 .mapInArrow(_probe, "key long, shard long, offset long, n_tokens long, "
                                     "rows long"))
        starts = self.shards().select("shard", F.col("start").alias("before"))
        return (found.join(starts, "shard")
                .select("key", "shard", "offset", "n_tokens", "rows",
                        (F.col("before") + F.col("offset")).alias("start")))

    def documents(self) -> DataFrame:
        """(key, start, n_tokens, ids_crc32) of every document, as the files and
        the index have them; the index gives the start of a key's first row."""
        entries = self.entries()
        found = self.locate(entries, "key").select(
            "key", F.col("shard").alias("_shard"), F.col("offset").alias("_offset"),
            F.col("start").alias("_start"))
        starts = self.shards().select("shard", F.col("start").alias("_before"))
        first = (F.col("shard") == F.col("_shard")) & (F.col("offset") == F.col("_offset"))
        return (spread_join(entries, found, "key", "left").join(starts, "shard")
                .select("key", F.when(first, F.col("_start")).otherwise(
                    F.col("_before") + F.col("offset")).alias("start"),
                    "n_tokens", "ids_crc32"))


class Reader:
    """Keyed access from one process: an index look-up, then one range read.

    ``folder`` lies where pyarrow's file systems reach it.
    """

    def __init__(self, folder: str):
        self.files, root = (FileSystem.from_uri(folder) if "://" in folder or
                            folder.startswith("file:") else FileSystem.from_uri(
                                f"file://{folder}"))
        self.root = unquote(root).rstrip("/")
        self.table = lambda name, **how: pq.read_table(
            f"{self.root}/{name}", filesystem=self.files, **how)
        shards = self.table("shards")
        self.width = {s: w for s, w in zip(*(shards.column(n).to_pylist()
                                             for n in ("shard", "width")))}
        parts = self.table("index", columns=["parts"]).column(0)
        self.parts = parts[0].as_py() if len(parts) else 0
        self.paths = {}
        for info in self.files.get_file_info(FileSelector(f"{self.root}/ids")):
            if match := re.fullmatch(r"part-(\d+)-.*", info.base_name):
                self.paths[int(match[1])] = info.path
        self.part = lru_cache(maxsize=64)(self._part)

    def _part(self, number: int) -> tuple[PerfectHash, np.ndarray] | None:
        rows = self.table("index", columns=["index", "slots"],
                          filters=[("part", "=", number)])
        if not rows.num_rows:
            return None
        return (PerfectHash.from_bytes(rows.column(0)[0].as_py()),
                np.frombuffer(rows.column(1)[0].as_py(), _SLOT))

    def ids(self, key: int) -> np.ndarray | None:
        """The ids of the first document with ``key``, end id included."""
        wanted = np.array([key], np.int64)
        held = self.part(int(_part(wanted, self.parts)[0])) if self.parts else None
        at = held[0].find(wanted)[0] if held else -1
        if at < 0:
            return None
        slot = held[1][at]
        width = self.width[int(slot["shard"])]
        with self.files.open_input_file(self.paths[int(slot["shard"])]) as file:
            data = file.read_at(int(slot["length"]) * width, int(slot["offset"]) * width)
        return np.frombuffer(data, f"<u{width}")
