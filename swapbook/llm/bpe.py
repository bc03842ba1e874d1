"""Byte-level BPE encoding and decoding by traversing a trie of the distinct words.

The last token of every prefix of a word decides its encoding: walking back from the end, each last token leads to
the prefix before it. A token t can be the last one of a prefix if it is a suffix of it and if t and the last token
of the prefix before it stay two tokens when their bytes are encoded alone; exactly one token does. Which tokens end at
a byte is read off an automaton over the vocabulary, whose state is kept per depth like the last token. So the distinct
words of a batch are put into a trie, which is walked depth first with a stack of last-token states, and what words
have in common at their start is computed once. The sorted words are that trie in depth-first order: the bytes that
a word shares with the one before it are the path down to the node where they part.

Rows are independent: each task encodes the batches it reads. The vocabulary is read on the driver and broadcast
(its size is that of the tokenizer file). Words met before are looked up in two tables of bounded size.

Defined cases: a null text is an empty one and has no tokens; repeated rows and other columns pass through.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swapbook.llm import ship

SPACE = r"\p{White_Space}"
WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|{SPACE}+(?![^{SPACE}])|{SPACE}+"
)
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same by Python's own classes, which is faster, for texts of characters that both take alike (``plain``).
PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^{_WHITE}\w]|_)+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_CLASSES = regex.compile(rf"(\p{{L}})|(\p{{N}})|({SPACE})"), re.compile(rf"([^\W\d_])|(\d)|([{_WHITE}])")
#: Words that a worker remembers twice over.
TABLE_WORDS = 150_000
TABLE_PAIRS = 500_000
TABLE_STEPS = 500_000
#: Documents and characters that are encoded at a time.
DOCS, CHARACTERS = 256, 1_000_000


def byte_of_character() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: printable bytes stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def plain(character: str) -> bool:
    """Whether both patterns put this character into the same class."""
    theirs, own = (c.fullmatch(character) for c in _CLASSES)
    return (theirs and theirs.lastindex) == (own and own.lastindex)


class ByteBpe:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        stand_in = byte_of_character()

        def raw(token: str) -> bytes:
            return bytes(stand_in[c] for c in token)

        self.id_of = {raw(token): i for token, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.added.items()}
        self.rank = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = raw(left), raw(right)
            self.rank[self.id_of[a], self.id_of[b]] = (rank, self.id_of[a + b])
        self.parts = {made: pair for pair, (_, made) in self.rank.items()}
        self.made_at = {made: rank for rank, made in self.rank.values()}
        #: each token comes from one merge, and after the tokens that it is made of
        self.ordered = len(self.parts) == len(self.rank) and all(
            rank > self.made_at.get(part, -1) for pair, (rank, _) in self.rank.items() for part in pair
        )
        self._automaton()
        self.split_added = regex.compile("(" + "|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")")
        self.alone: dict[int, bool] = {}
        #: two generations: words that were not met again since the last one began are forgotten
        self.table: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.plain: set[str] = set()
        self.size_of = {i: len(b) for b, i in self.id_of.items()}

    def merged(self, data: bytes) -> list[int]:
        """Plain merging by rank; used on pairs of tokens only."""
        ids = [self.id_of[bytes((b,))] for b in data]
        while len(ids) > 1:
            best = min(((self.rank[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank), default=None)
            if best is None:
                break
            i = best[1]
            ids[i : i + 2] = [self.rank[ids[i], ids[i + 1]][1]]
        return ids

    def _automaton(self) -> None:
        """An automaton over the bytes of the tokens: where it stands after some bytes tells all tokens that end there.

        ``step`` leads from node and byte to a node, ``back`` to the node of the longest proper suffix that is one, and
        ``ends`` lists the tokens (with their sizes) that are suffixes of a node, longest first.
        """
        self.step: dict[int, int] = {}
        token_at = {}
        nodes = 1
        for token, number in self.id_of.items():
            node = 0
            for byte in token:
                place = node << 8 | byte
                node = self.step.setdefault(place, nodes)
                nodes += node == nodes
            token_at[node] = (number, len(token))
        below: list[list[tuple[int, int]]] = [[] for _ in range(nodes)]
        for place, node in self.step.items():
            below[place >> 8].append((place & 255, node))
        self.back, self.ends = [0] * nodes, [()] * nodes
        level = [0]
        while level:
            following = []
            for parent in level:
                for byte, node in below[parent]:
                    self.back[node] = self.moved(self.back[parent], byte) if parent else 0
                    own = (token_at[node],) if node in token_at else ()
                    self.ends[node] = own + self.ends[self.back[node]]
                    following.append(node)
            level = following

    def moved(self, node: int, byte: int) -> int:
        """The node that ``byte`` leads to; found once, then a step of its own (one for each node and byte in use)."""
        place = node << 8 | byte
        found = self.step.get(place)
        if found is None:
            found = self.moved(self.back[node], byte) if node else 0
            if len(self.step) < TABLE_STEPS:
                self.step[place] = found
        return found

    def stay_apart(self, before: int, token: int) -> bool:
        """Whether ``before`` (-1: none) followed by ``token`` is an encoding."""
        place = (before << 32) + token
        known = self.alone.get(place)
        if known is None:
            if len(self.alone) >= TABLE_PAIRS:
                self.alone.clear()
            known = self.alone[place] = self._apart(before, token)
        return known

    def _apart(self, before: int, token: int) -> bool:
        if before < 0 or not self.ordered:
            tokens = [token] if before < 0 else [before, token]
            return self.merged(b"".join(self.bytes_of[t] for t in tokens)) == tokens
        # undo the merges on both sides of the border, latest first; the two tokens that meet there must never have a
        # merge that comes before the one undone last. Of equal merges the left one comes first.
        limit = len(self.rank)
        while True:
            across = self.rank.get((before, token))
            if across is not None and across[0] < limit:
                return False
            left, right = self.made_at.get(before, -1), self.made_at.get(token, -1)
            if left < 0 and right < 0:
                return True
            if left > right:
                limit, before = left, self.parts[before][1]
            else:
                limit, token = right + 1, self.parts[token][0]

    def encode_words(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """The encodings of distinct words, by one walk over their trie."""
        found = {}
        step, ends, alone, size_of = self.step, self.ends, self.alone, self.size_of
        last, nodes = [-1], [0]  # last token of the path to each depth, the automaton there
        path = b""
        for data, word in sorted((w.encode("utf-8"), w) for w in words):
            same, most = 0, min(len(path), len(data))
            while same < most and path[same] == data[same]:
                same += 1
            del last[same + 1 :], nodes[same + 1 :]
            node = nodes[same]
            for end in range(same + 1, len(data) + 1):
                to = step.get(node << 8 | data[end - 1])
                node = self.moved(node, data[end - 1]) if to is None else to
                nodes.append(node)
                for token, length in ends[node]:
                    before = last[end - length]
                    apart = alone.get((before << 32) + token)
                    if apart or (apart is None and self.stay_apart(before, token)):
                        last.append(token)
                        break
            path, at, ids = data, len(data), []
            while at:
                ids.append(last[at])
                at -= size_of[last[at]]
            ids.reverse()
            found[word] = tuple(ids)
        return found

    def words(self, text: str) -> list[str]:
        """Words and added tokens of a text, in order."""
        unknown = set(text) - self.plain
        if unknown:
            met = {c for c in unknown if plain(c)}
            self.plain |= met
            unknown -= met
        pattern = WORDS if unknown else PLAIN_WORDS
        parts = self.split_added.split(text)
        if len(parts) == 1:
            return pattern.findall(text)
        return list(chain.from_iterable([p] if p in self.added else pattern.findall(p) for p in parts))

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.words(t) for t in texts]
        distinct = set(chain.from_iterable(split))
        if len(self.table) > TABLE_WORDS:
            self.table, self.old = {}, self.table
        table, old = self.table, self.old
        missing = distinct.difference(table, self.added)
        table.update({w: old[w] for w in missing if w in old})
        table.update(self.encode_words(w for w in missing if w not in old))
        table.update({content: (i,) for content, i in self.added.items()})
        return [list(chain.from_iterable(map(table.__getitem__, words))) for words in split]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def parts(texts: list[str | None]) -> Iterator[slice]:
    """Slices of bounded size; a text of any length is never cut."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= DOCS or held + len(text or "") > CHARACTERS):
            yield slice(start, i)
            start, held = i, 0
        held += len(text or "")
    if start < len(texts):
        yield slice(start, len(texts))


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``decoded`` (the text of these ids)."""
    with open(path, encoding="utf-8") as file:
        shared = ship.broadcast(docs.sparkSession.sparkContext, ByteBpe(file.read()))
    own = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ship.received(shared)  # one per worker process, with its tables, for all the tasks it runs
        for batch in batches:
            for part in parts(batch.column(own.index(text)).to_pylist()):
                rows = batch.slice(part.start, part.stop - part.start)
                ids = model.encode([t or "" for t in rows.column(own.index(text)).to_pylist()])
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                decoded = pa.array([model.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, listed, decoded], [*own, "ids", "decoded"])

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    done = encode(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), path)
    listed = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
