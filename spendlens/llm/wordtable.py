"""Byte-pair encoding and decoding through a table of distinct words.

A word is the text between two boundaries, and a boundary is a single space between two characters that are
not white space: there the tokenizer always starts a new piece, so that the ids of a text are those of its words
in order. Documents are gathered in blocks; a block keeps its texts as numbers of its own distinct words and
sends each of these words, packed by hash, to the task that owns the hash. There every word is encoded once,
whatever the number of blocks that hold it, and the ids go back to the blocks, where they are put in the
words' places. Decoding takes each id's piece from the vocabulary, which has a fixed size and goes to all tasks.

A pack holds the words that one block sends to one owner, so there are never more packs than distinct words
of blocks; owners grow in number with the input, which bounds what one of them gets. A lost executor's blocks are made anew: the documents should be a stored table,
which every attempt reads in the same order. Null texts are empty and
have no ids. Rows are treated one by one, so keys may be null or repeat.

A text is one value in a task, however long. Columns beside key and text are ignored, whatever their names.
"""

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from spendlens.llm.common import table
from spendlens.llm.kernels import ranges

BLOCK = 8 << 20  # characters of text in a block
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
_IDS = 1 << 19  # ids put in place at once


def vocabulary(path: str | None = None) -> str:
    """The tokenizer file as text; by default the public byte-level vocabulary of 50,257 ids."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=2)
def load(model: str) -> Tokenizer:
    """The tokenizer of a file's text, once per process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_str(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=2)
def pieces(model: str) -> pa.Array:
    """The bytes of each id. Byte-level vocabularies write the bytes that do not print as later code points."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    parts = json.loads(model)
    names = dict(parts["model"]["vocab"]) | {x["content"]: x["id"] for x in parts["added_tokens"]}
    found = [b""] * (max(names.values()) + 1)
    for name, i in names.items():
        found[i] = bytes(map(byte_of.__getitem__, name)) if all(c in byte_of for c in name) else name.encode()
    return pa.array(found, pa.large_binary())


@lru_cache(maxsize=2)
def _decimals(n: int) -> pa.Array:
    return pa.array([b"%d," % i for i in range(n)], pa.large_binary())


class _Block:
    """Texts as numbers of the block's distinct words."""

    def __init__(self) -> None:
        self.later: dict[str, int] = {}  # words after a space, without it
        self.first: dict[str, int] = {}
        self.words: list[str] = []
        self.keys: list[pa.Array] = []
        self.codes: list[np.ndarray] = []
        self.chars = 0

    def _new(self, table: dict[str, int], word: str, code: str) -> int:
        # white space at a word's edge may belong to a longer run: such texts are cut at true boundaries
        if code != word and (not word or word[0].isspace() or word[-1].isspace()):
            return -1
        table[word] = number = len(self.words)
        self.words.append(code)
        return number

    def add(self, text: str) -> None:
        self.chars += len(text)
        if not text:
            self.codes.append(np.zeros(0, np.int32))
            return
        head, *rest = text.split(" ")
        if rest and (not head or head[-1].isspace()) or (codes := self._codes(rest)) is None:
            head, *rest = _BOUNDARY.split(text)
            codes = [self.later[w] if w in self.later else self._true(w) for w in rest]
        number = self.first.get(head)
        if number is None:
            number = self._new(self.first, head, head)
        self.codes.append(np.array([number, *codes], np.int32))

    def _true(self, word: str) -> int:
        self.later[word] = number = len(self.words)
        self.words.append(" " + word)
        return number

    def _codes(self, rest: list[str]) -> list[int] | None:
        known, codes = self.later, list(map(self.later.get, rest))
        if None in codes:
            for i, word in enumerate(rest):
                if codes[i] is None:
                    number = known.get(word)
                    codes[i] = self._new(known, word, " " + word) if number is None else number
                    if codes[i] < 0:
                        return None
        return codes

    def rows(self, number: int, owners: int) -> Iterator[pa.RecordBatch]:
        if not self.codes:
            return
        owner = np.array([xxhash.xxh64_intdigest(w.encode()) % owners for w in self.words], np.int64)
        codes = np.concatenate(self.codes)
        # frequent words get small numbers, which pack well
        order = np.argsort(-np.bincount(codes, minlength=len(owner)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        owner = owner[order]
        dealt = np.argsort(owner, kind="stable")
        held, starts = np.unique(owner[dealt], return_index=True)
        packs = [_pack_words([self.words[i] for i in own.tolist()]) for own in np.split(order[dealt], starts[1:]) if len(own)]
        keys, n = pa.concat_arrays(self.keys), len(held)
        one = lambda x, kind: pa.array([x, *[None] * n], kind)
        own = pa.ListArray.from_arrays(pa.array([0, len(keys), *[len(keys)] * n], pa.int32()), keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number, *(-1 - held).tolist()], pa.int64()), pa.array([number] * (n + 1), pa.int64()),
             pa.array([-1, *held.tolist()], pa.int32()), own,
             one(list(map(len, self.codes)), pa.list_(pa.int32())),
             one(zstandard.compress(_planes(place[codes] if len(codes) else codes), 3), pa.binary()),
             one(_small(owner), pa.binary()), pa.array([None, *packs], pa.binary())],
            names=["to", "block", "owner", "keys", "lengths", "codes", "owners", "words"])


def _pack_words(words: list[str]) -> bytes:
    lengths = _small(np.fromiter(map(len, words), np.int64, len(words)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.compress("".join(words).encode(), 3)


def _unpack_words(pack: bytes) -> list[str]:
    size = int.from_bytes(pack[:4], "little")
    ends = np.cumsum(_wide(pack[4:4 + size])).tolist()
    text = zstandard.decompress(pack[4 + size:]).decode()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _planes(codes: np.ndarray) -> bytes:
    """Low bytes, middle bytes and so on, one after the other: small numbers pack well."""
    return np.ascontiguousarray(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _codes(packed: bytes) -> np.ndarray:
    data = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return np.ascontiguousarray(data.reshape(4, -1).T).view("<i4").ravel()


def split(docs: DataFrame, key: str, text: str, owners: int, block: int) -> DataFrame:
    """One row per block with its texts (owner -1), and one per pack of words for an owner.

    ``to`` is the block itself, or a negative number for the owner.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, current = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            first = 0
            texts = batch.column(1).to_pylist()
            for row, value in enumerate(texts):
                current.add(value or "")
                if current.chars >= block:
                    current.keys.append(batch.column(0)[first:row + 1])
                    yield from current.rows(number, owners)
                    number, current, first = number + 1, _Block(), row + 1
            if first < len(texts):
                current.keys.append(batch.column(0)[first:])
        yield from current.rows(number, owners)

    schema = T.StructType([
        T.StructField("to", T.LongType()), T.StructField("block", T.LongType()), T.StructField("owner", T.IntegerType()),
        T.StructField("keys", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("codes", T.BinaryType()), T.StructField("owners", T.BinaryType()), T.StructField("words", T.BinaryType())])
    return rows.mapInArrow(run, schema)


def _small(values: np.ndarray) -> bytes:
    kind = next(k for k in ("<u1", "<u2", "<u4") if not len(values) or values.max() <= np.iinfo(k).max)
    return kind[-1:].encode() + zstandard.compress(values.astype(kind).tobytes(), 3)


def _wide(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed[1:]), f"<u{packed[:1].decode()}").astype(np.int64)


def _encode_words(model) -> "callable":
    def run(packs: pa.Table) -> pa.Table:
        packs = packs.filter(pc.greater_equal(packs["owner"], 0))
        numbers: dict[str, int] = {}
        codes, edges = [], [0]
        for pack in packs["words"].to_pylist():
            codes += [numbers.setdefault(w, len(numbers)) for w in _unpack_words(pack)]
            edges.append(len(codes))
        tokenizer, words, ids = load(model.value), list(numbers), []
        for at in range(0, len(words), 10_000):
            ids += [np.array(x.ids, np.int64) for x in tokenizer.encode_batch(words[at:at + 10_000], add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate([np.zeros(0, np.int64), *ids])
        starts, codes = np.cumsum(sizes) - sizes, np.array(codes, np.int64)
        lengths, all_ids = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            own = codes[a:b]
            lengths.append(_small(sizes[own]))
            all_ids.append(_small(flat[ranges(starts[own], sizes[own])]))
        return pa.table({"to": packs["block"], "owner": packs["owner"], "sizes": pa.array(lengths, pa.binary()),
                         "ids": pa.array(all_ids, pa.binary())})

    return run


def _put_in_place(texts: pa.Table, packs: pa.Table, view: "View", model) -> pa.Table:
    texts = texts.filter(pc.equal(texts["owner"], -1))
    if not len(texts):
        nothing = view(pa.array([], pa.list_(pa.int32())), model.value)
        return pa.table({"key": pa.array([], texts.schema.field("keys").type.value_type)} | nothing)
    packs = packs.sort_by("owner")
    nothing = np.zeros(0, np.int64)
    sizes = np.concatenate([nothing, *[_wide(x) for x in packs["sizes"].to_pylist()]])
    flat = np.concatenate([nothing, *[_wide(x) for x in packs["ids"].to_pylist()]]).astype(np.int32)
    # the packs hold the words by owner; texts number them by frequency
    order = np.argsort(_wide(texts["owners"][0].as_py()), kind="stable")
    starts = np.empty_like(sizes)
    starts[order] = np.cumsum(sizes) - sizes
    sizes[order] = sizes.copy()
    keys = texts["keys"].combine_chunks().flatten()
    lengths = texts["lengths"].combine_chunks().flatten().to_numpy()
    codes, edges = _codes(texts["codes"][0].as_py()), np.concatenate([[0], np.cumsum(lengths)])
    out, row = [], 0
    while row < len(keys):
        last = max(row + 1, int(np.searchsorted(edges, edges[row] + _IDS // 4, "right")) - 1)
        own = codes[edges[row]:edges[last]]
        ids = flat[ranges(starts[own], sizes[own])]
        cuts = np.concatenate([[0], np.cumsum(sizes[own])])[edges[row:last + 1] - edges[row]]
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids))
        out.append(pa.table({"key": keys[row:last]} | view(lists, model.value)))
        row = last
    return pa.concat_tables(out)


def _taken(values: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all ids, one after the other, and where each begins."""
    found = values.take(ids)
    _, offsets, data = found.buffers()
    offsets = np.frombuffer(offsets, np.int64)[found.offset:found.offset + len(found) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _joined(values: pa.Array, lists: pa.ListArray) -> Iterator[np.ndarray]:
    """For each row the values of its ids as one run of bytes; a bounded number of ids is looked up at once."""
    edges = lists.offsets.to_numpy()
    ids, edges, row = lists.flatten(), edges - edges[0], 0
    while row < len(lists):
        last = max(row + 1, int(np.searchsorted(edges, edges[row] + _IDS, "right")) - 1)
        data, offsets = _taken(values, ids[edges[row]:edges[last]])
        cuts = offsets[edges[row:last + 1] - edges[row]]
        yield from (data[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
        row = last


def _texts(lists: pa.ListArray, model: str) -> Iterator[str]:
    return (x.tobytes().decode("utf-8", "replace") for x in _joined(pieces(model), lists))


# What is made of the ids of a run of rows, by column; the model is the tokenizer file's text.
View = Callable[[pa.ListArray, str], dict[str, pa.Array]]


def ids_view(lists: pa.ListArray, model: str) -> dict[str, pa.Array]:
    return {"ids": lists}


def text_view(lists: pa.ListArray, model: str) -> dict[str, pa.Array]:
    return {"text": pa.array(_texts(lists, model), pa.string())}


def both_view(lists: pa.ListArray, model: str) -> dict[str, pa.Array]:
    return ids_view(lists, model) | text_view(lists, model)


def digest_view(lists: pa.ListArray, model: str) -> dict[str, pa.Array]:
    """Number of ids, and digests of the ids in decimal and of the text decoded from them."""
    listed = _joined(_decimals(len(pieces(model))), lists)
    return {
        "n_tokens": pa.array(np.diff(lists.offsets.to_numpy()), pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(x[:max(0, len(x) - 1)]).hexdigest() for x in listed], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in _texts(lists, model)], pa.string()),
    }


VIEWS: dict[View, str] = {
    ids_view: "ids array<int>", text_view: "text string", both_view: "ids array<int>, text string",
    digest_view: "n_tokens long, ids_sha256 string, decoded_sha256 string",
}


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None,
           block: int = BLOCK, view: View = ids_view) -> DataFrame:
    """(key, ids): the ids of each whole text, as the tokenizer gives them without special tokens of its own.

    Another ``view`` gives what is decoded from the ids, or both, or digests, without moving the ids again.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(model or vocabulary())
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    # one exchange takes texts to their blocks' place and words to their owners; both sides below read it
    dealt = split(docs, key, text, owners, block).repartition("to")
    kind = dealt.schema["keys"].dataType.elementType.simpleString()
    packs = dealt.groupBy("to").applyInArrow(_encode_words(model), "to long, owner int, sizes binary, ids binary")

    def put(texts: pa.Table, packs: pa.Table) -> pa.Table:
        return _put_in_place(texts, packs, view, model)

    return dealt.groupBy("to").cogroup(packs.groupBy("to")).applyInArrow(put, f"key {kind}, {VIEWS[view]}")


def decode(tokens: DataFrame, key: str = "key", ids: str = "ids", model: str | None = None, view: View = text_view) -> DataFrame:
    """(key, text): pieces of all ids joined; bytes that are no UTF-8 become replacement characters. Null is empty."""
    shared = tokens.sparkSession.sparkContext.broadcast(model or vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"key": batch.column(0)} | view(batch.column(1), shared.value))

    empty = F.expr("cast(array() as array<int>)")
    rows = tokens.select(F.col(key).alias("key"), F.coalesce(F.col(ids), empty).alias("ids"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, {VIEWS[view]}")


def op9(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), view=digest_view).withColumnRenamed("key", "doc_id")
