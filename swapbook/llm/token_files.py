"""Token ids in binary files of directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level 0 has the first chunk of every id; level l + 1 has the next
chunk of those ids of level l that have more, in the same order. A bitmap of each level tells which ids go on, and a
directory holds the number of ones before every 512 bits of it. So the id at any place is read by one step a level:
take the chunk, and if its bit is set, go to the place that the directory and at most eight words of the bitmap give.
Nothing before it is decoded, and small ids, which are the frequent ones, take one byte.

Documents are dealt into ranges of their id and sorted there; each task encodes its range and packs runs of whole
documents into files of about ``FILE_TOKENS`` ids. ``parts`` of the result folder has the files, ``index`` a Parquet
table with the place of the first id of each file among all ids. Files are written and read by Spark, so any file system
that it knows will do, and a repeated task writes the same files again.

Encoding is done by the tokenizers library, once per distinct piece of text of a task: no token reaches over the end of
a run of other characters into white space, and one that begins with a space begins a run, so the pieces between such
places can be encoded alone.

Layout of a file, numbers little-endian, each part filled up to eight bytes: a line of 128 ASCII characters (part, number,
documents, ids, levels), the sizes of the levels, document ids, whether they are known, ends of the documents, and per
level the chunks, the bitmap and its directory (the last level has neither).

Defined cases: a null text is an empty one and has its end id only; documents without an id come first; documents of
equal id follow each other in the order of a hash of their text; repeated rows are kept; other columns are left out;
an empty table makes no file. A document is never cut, so a file is at least as long as its longest document.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from swapbook.llm import ship

CHUNK = 8
BITS_PER_ENTRY = 512
HEAD = 128
MAGIC = "DAC1"
#: Ids of a file, about. Larger ones make fewer files and need more memory to pack (some 20 bytes per id).
FILE_TOKENS = 1 << 22
#: The id that ends a document.
END = 2
#: Pieces that a worker remembers twice over, and the longest of them.
TABLE, LONGEST = 300_000, 64

# Characters besides the space that the pattern of the tokenizer takes for white space; Python's own class has a few more.
_WHITE = "\t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space other than one single space.
_RUNS = re.compile(f"([{_WHITE} ]{{2,}}|[{_WHITE}])")
#: What a text of words, single spaces and line ends does not have.
_ODD = ("  ", " \n", "\n\n\n", "\n\n ", *_WHITE.replace("\n", ""))


class Encoder:
    """Ids of whole texts as little-endian bytes, by the tokenizers library and a table of known pieces.

    A key of the table is a word that stands after a space, a line end with the word behind it (or with none), or
    another run of white space in a tuple. The table has two generations: pieces that were not met again since the
    last one began are forgotten.
    """

    def __init__(self, spec: str):
        self.spec, self.library = spec, None
        self.added = [t["content"] for t in json.loads(spec)["added_tokens"]]
        self.odd = (*_ODD, *self.added)
        self.young: dict = {}
        self.old: dict = {}

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _start(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's cores are Spark's
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(self.spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.newline = self._library(["\n"])[0].tobytes()

    def _learn(self, keys: set) -> None:
        """Put these keys into the young table."""
        young, old = self.young, self.old
        new = []
        for key in keys:
            if (known := old.get(key)) is not None:
                young[key] = known
            else:
                new.append(key)
        single = [k for k in new if isinstance(k, tuple) or k in ("", "\n") or any(a in k for a in self.added)]
        texts = [k[0] if isinstance(k, tuple) else k if k[:1] == "\n" else " " + k for k in single]
        young.update(zip(single, (x.tobytes() for x in self._library(texts))))
        # many pieces in one text: a line end parts them, and no piece has its id
        alone = set(single)
        many = [k for k in new if k not in alone]
        parts = [many[i : i + 512] for i in range(0, len(many), 512)]
        line = np.frombuffer(self.newline, "<u4")[0]
        for part, ids in zip(parts, self._library(["".join(k if k[0] == "\n" else "\n " + k for k in p) for p in parts])):
            at = np.flatnonzero(ids == line)
            assert len(at) == len(part)
            data, ends = ids.tobytes(), np.append(at[1:], len(ids)) * 4
            # a key that begins with a line end has its id before the word
            begins = at * 4 + 4
            young.update({k: data[b - 4 if k[0] == "\n" else b : e] for k, b, e in zip(part, begins.tolist(), ends.tolist())})

    def _pieces(self, text: str) -> list[tuple]:
        """(key, bytes to leave out) of the pieces of any text without added tokens."""
        found, joined = [], False
        parts = _RUNS.split(text)
        for at, part in enumerate(parts):
            if at % 2 and at == len(parts) - 2 and not parts[-1]:
                found.append(((part,), 0))
            elif at % 2:  # the last character of a run stands alone, or with the next word if it is a space
                joined = part[-1] == " "
                found += [((p,), 0) for p in (part[:-1], "" if joined else part[-1]) if p]
            elif part:
                words = part.split(" ")
                if not joined:
                    first = words.pop(0)
                    found += [("\n" + first, len(self.newline))] if first else []
                found += [(w or (" ",), 0) for w in words]
                joined = False
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.library is None:
            self._start()
        if len(self.young) > TABLE:
            self.young, self.old = {}, self.young
        young = self.young
        plans, wanted = [], set()
        for text in texts:
            if any(a in text for a in self.added):
                plans.append((0, text))
            elif text.endswith((" ", "\n\n")) or any(o in text for o in self.odd):
                pieces = self._pieces(text)
                wanted.update(k for k, _ in pieces if k not in young)
                plans.append((1, pieces))
            else:
                words = text.replace("\n", " \n").split(" ")
                words[0] = "\n" + words[0]  # nothing stands before it: the line end is taken off again
                wanted.update([w for w in words if w not in young])
                plans.append((2, words))
        self._learn(wanted)
        found = []
        for kind, plan in plans:
            if kind == 0:
                found.append(self._library([plan])[0].tobytes())
            elif kind == 1:
                found.append(b"".join([young[k][skip:] for k, skip in plan]))
            else:
                found.append(b"".join(map(young.__getitem__, plan))[len(self.newline) :])
        for key in [k for k in wanted if len(k if isinstance(k, str) else k[0]) > LONGEST]:
            del young[key]
        return found


def _filled(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap words and directory of each level."""
    found, rest = [], ids.astype(np.uint32)
    while True:
        chunks = (rest & 0xFF).astype(np.uint8)
        more = rest >= 1 << CHUNK
        if not more.any():
            nothing = np.zeros(0, np.uint64)
            return [*found, (chunks, nothing, nothing)]
        bits = np.packbits(more, bitorder="little").tobytes()
        words = np.frombuffer(bits + b"\0" * (-len(bits) % (BITS_PER_ENTRY // 8)), "<u8")
        ones = np.bitwise_count(words).reshape(-1, BITS_PER_ENTRY // 64).sum(axis=1, dtype=np.uint64)
        found.append((chunks, words, np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint64)))
        rest = rest[more] >> CHUNK


@dataclass
class File:
    """Views into the bytes of a file."""

    part: int
    no: int
    doc_ids: np.ndarray
    known: np.ndarray
    ends: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def tokens(self, at: np.ndarray) -> np.ndarray:
        """The ids at these places, one step a level."""
        at = np.asarray(at, np.int64)
        found, asked = np.zeros(len(at), np.uint32), np.arange(len(at))
        for level, (chunks, words, before) in enumerate(self.levels):
            found[asked] |= chunks[at].astype(np.uint32) << np.uint32(CHUNK * level)
            if level == len(self.levels) - 1 or not len(at):
                break
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            on = (words[word] >> bit) & np.uint64(1) == 1
            asked, at, word, bit = asked[on], at[on], word[on], bit[on]
            entry = at // BITS_PER_ENTRY
            rank = before[entry].astype(np.int64)
            for k in range(BITS_PER_ENTRY // 64):  # whole words between the entry and the place
                w = entry * (BITS_PER_ENTRY // 64) + k
                rank += np.where(w < word, np.bitwise_count(words[w]), 0).astype(np.int64)
            rank += np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            at = rank
        return found

    def all_tokens(self) -> np.ndarray:
        rest = None
        for chunks, words, _ in reversed(self.levels):
            ids = chunks.astype(np.uint32)
            if rest is not None:
                more = np.unpackbits(words.view(np.uint8), bitorder="little", count=len(chunks)).view(bool)
                ids[more] |= rest << np.uint32(CHUNK)
            rest = ids
        return rest


def pack(part: int, no: int, doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """A file of whole documents."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    levels = levels_of(flat)
    head = f"{MAGIC} part={part:010d} no={no:010d} docs={len(ids):015d} tokens={len(flat):015d} levels={len(levels):02d}"
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
    known = np.array([i is not None for i in doc_ids], np.uint8)
    pieces = [
        np.array([len(c) for c, _, _ in levels], "<i8").tobytes(), np.array([i or 0 for i in doc_ids], "<i8").tobytes(), known.tobytes(),
        ends.astype("<i8").tobytes(), *[x.tobytes() for level in levels for x in level],
    ]
    return head.ljust(HEAD - 1).encode() + b"\n" + b"".join(map(_filled, pieces))


def unpack(data: bytes | pa.Buffer) -> File:
    fields = dict(x.split("=") for x in bytes(data[:HEAD]).decode().split()[1:])
    docs, n_levels = int(fields["docs"]), int(fields["levels"])
    at = HEAD

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, n, at)
        at += found.nbytes + -found.nbytes % 8
        return found

    sizes = take("<i8", n_levels)
    doc_ids, known, ends = take("<i8", docs), take("u1", docs), take("<i8", docs)
    levels = []
    for k, n in enumerate(sizes.tolist()):
        entries = -(-n // BITS_PER_ENTRY) if k < n_levels - 1 else 0
        levels.append((take("u1", n), take("<u8", entries * BITS_PER_ENTRY // 64), take("<u8", entries)))
    return File(int(fields["part"]), int(fields["no"]), doc_ids, known.view(bool), ends, levels)


def _slices(sizes: list[int], characters: int = 2_000_000, rows: int = 512) -> Iterator[slice]:
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > characters or i - start >= rows):
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def packed(docs: DataFrame, path: str, id_col: str, text: str, file_tokens: int, end: int) -> DataFrame:
    """(content): the files, in order of document id over the partitions."""
    with open(path, encoding="utf-8") as file:
        shared = ship.broadcast(docs.sparkSession.sparkContext, Encoder(file.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = ship.received(shared), TaskContext.get().partitionId()
        last = np.array([end], "<u4").tobytes()
        no, held, names, lists = 0, 0, [], []

        def content() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack(part, no, names, lists)], pa.binary())], ["content"])

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = batch.column(0).to_pylist()
            for some in _slices([len(t) for t in texts]):
                for name, tokens in zip(ids[some], encoder.encode(texts[some])):
                    names.append(name)
                    lists.append(tokens + last)
                    held += len(tokens) // 4 + 1
                    if held >= file_tokens:
                        yield content()
                        no, held, names, lists = no + 1, 0, [], []
        if names:
            yield content()

    tie = F.xxhash64("text")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # rows alike in id and text may be dealt to several ranges: one document repeated is not one task
    dealt = narrow.withColumns({"_tie": tie, "_any": F.monotonically_increasing_id()})
    ranged = dealt.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_tie", "_any")
    ordered = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie", "_any").select("doc_id", "text")
    return ordered.mapInArrow(run, "content binary")


def write(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text: str = "text", file_tokens: int = FILE_TOKENS,
          end: int = END) -> None:
    """Write ``folder``/parts and ``folder``/index; ``path`` names the tokenizer file on the driver."""
    spark = docs.sparkSession
    rows = packed(docs, path, id_col, text, file_tokens, end)
    # text without an encoding: the bytes are written as they are, one row a file, and a line end that is never read
    rows.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "compression", "none"
    ).text(f"{folder}/parts")
    head = F.substring("content", 1, HEAD).cast("string")
    number = lambda name: F.regexp_extract(head, f"{name}=(\\d+)", 1).cast("long").alias(name)
    files = _files(spark, folder).select("path", *[number(n) for n in ("part", "no", "docs", "tokens")])
    within = Window.partitionBy("part").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("_in", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    # a row per file, and one per task that wrote: the latter are summed up in one place
    totals = files.groupBy("part").agg(F.sum("tokens").alias("_total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_before"))
    index = placed.join(starts, "part").select("path", "part", "no", "docs", "tokens", (F.col("_before") + F.col("_in")).alias("start"))
    index.write.parquet(f"{folder}/index")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{folder}/parts").filter(F.col("length") > HEAD).select("path", "content")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """path, part, no, docs, tokens, start: one row per file."""
    return spark.read.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files; with its ids if wanted."""
    fields = "part long, no long, doc_id long, _in long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = unpack(content.as_buffer())
                flat = file.all_tokens().astype("<u4")
                begins = np.concatenate([[0], file.ends[:-1]])
                data = memoryview(flat.tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), file.ends.tolist())]
                n = len(crc)
                columns = [
                    pa.array(np.full(n, file.part)), pa.array(np.full(n, file.no)), pa.array(file.doc_ids, mask=~file.known),
                    pa.array(begins), pa.array(file.ends - begins), pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begins, file.ends[-1]).astype(np.int32)), pa.array(flat.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in fields.split(", ")] + ["ids"] * with_ids)

    rows = _files(spark, folder).select("content").mapInArrow(run, fields + ", ids array<long>" * with_ids)
    starts = index(spark, folder).select("part", "no", "start")
    placed = rows.join(starts, ["part", "no"])
    return placed.select("doc_id", (F.col("start") + F.col("_in")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """(position, id) for distinct places among all ids; places beyond them have no row.

    A place finds its file by the stretches of ``FILE_TOKENS`` ids that the file touches, and is read from it alone.
    """
    files = index(spark, folder).filter("tokens > 0")
    stretch = lambda c: F.floor(c / F.lit(FILE_TOKENS)).cast("long")
    touched = files.select(
        "path", "start", "tokens", F.explode(F.sequence(stretch(F.col("start")), stretch(F.col("start") + F.col("tokens") - 1))).alias("_s")
    )
    asked = positions.select(F.col("position").cast("long").alias("position")).dropna().distinct().withColumn("_s", stretch(F.col("position")))
    met = asked.join(touched, "_s").filter("position >= start and position < start + tokens")
    per_file = met.groupBy("path", "start").agg(F.collect_list("position").alias("positions"))  # at most the ids of a file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, start, wanted in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2)):
                at = wanted.values.to_numpy(zero_copy_only=False)
                ids = unpack(content.as_buffer()).tokens(at - start)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids.astype(np.int64))], ["position", "id"])

    return _files(spark, folder).join(per_file, "path").select("content", "start", "positions").mapInArrow(run, "position long, id long")
