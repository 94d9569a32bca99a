"""Byte-level BPE by overlapping chunks, and decoding.

A long text is cut into chunks that overlap. Tasks pre-tokenise chunks in parallel, each from its
own first character, which need not be where a pre-token begins. Neighbours then compare the
boundaries they found in the overlap: from the first common one on, both go on alike, since what
a pre-token is depends only on what follows its start. The text is cut there and each piece is
encoded by itself. A common boundary counts if a run of letters or of digits ends at it, for
such a place parts pre-tokens whatever stands around it. Where an overlap has none (one word of
many thousand letters), the two chunks are joined again before they are encoded, so the result
never depends on the size of the chunks.

This is done at two sizes. A text of over 33,792 characters is dealt out over tasks in chunks of
32,768; inside a task every text, or piece of one, is taken in chunks of 1,024. Only a text that fits
one of those is encoded in one go.

Decoding puts the bytes of the ids together.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK = 32_768
OVERLAP = 1_024
# Inside a task.
PART = 1_024
PART_OVERLAP = 64
BATCH_IDS = 1 << 20

Emitter = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The encoder of a rank file, made once in each worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def boundaries(text: str, begin: int, end: int, pattern) -> list[int]:
    """Starts of pre-tokens of ``text`` in ``begin`` to ``end`` that end a run of letters or digits.

    The last pre-token may go on behind the text and is no evidence; its start is.
    """
    starts = [match.start() for match in pattern.finditer(text)]
    return _safe(text, [at for at in starts if begin <= at < end])


def _safe(text: str, starts: list[int]) -> list[int]:
    return [at for at in starts if at and SAFE.match(text, at - 1)]


SAFE = regex.compile(r"\p{L}(?!\p{L})|\p{N}(?!\p{N})")


def meetings(text: str, size: int, overlap: int, pattern) -> list[int]:
    """Where neighbouring chunks of ``text`` go on alike, one place for each pair that has one.

    The chunk before is read from ``overlap`` characters in front of the next one's start, which is
    as good as any other place: only boundaries that stand wherever reading starts are compared.
    """
    found = []
    for at in range(size, len(text) - overlap, size):
        before = max(0, at - overlap)
        tail = boundaries(text[before : at + 2 * overlap], at - before, at - before + overlap, pattern)
        head = boundaries(text[at : at + 2 * overlap], 0, overlap, pattern)
        common = {before + b for b in tail}.intersection(at + b for b in head)
        if common:
            found.append(min(common))
    return found


def encoded_pieces(
    text: str, encoding: tiktoken.Encoding, pattern, size: int = PART, overlap: int = PART_OVERLAP
) -> list[int]:
    """The ids of a text: those of the pieces between its chunks' meetings, one after the other."""
    if len(text) <= size + overlap:
        return encoding.encode_ordinary(text)
    cuts = [0, *meetings(text, size, overlap, pattern), len(text)]
    ids: list[int] = []
    for begin, end in zip(cuts, cuts[1:]):
        ids += encoding.encode_ordinary(text[begin:end])
    return ids


def _chunks(size: int, overlap: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                starts = range(0, max(1, len(text) - overlap), size)
                for k, at in enumerate(starts):
                    last = k == len(starts) - 1
                    part = text[at:] if last else text[at : at + size + overlap]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rid]), pa.array([k], pa.int64()), pa.array([last]), pa.array([part])],
                        names=["rid", "k", "last", "part"],
                    )

    return emit


def _bounds(size: int, overlap: int, source: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(source)
        for batch in batches:
            heads, tails = [], []
            for k, last, part in zip(*(batch.column(c).to_pylist() for c in ("k", "last", "part")), strict=True):
                heads.append(boundaries(part[: 2 * overlap], 0, overlap, pattern) if k else [])
                tails.append(
                    [] if last else [b - size for b in boundaries(part, size, size + overlap, pattern)]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("k"), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                names=["rid", "k", "head", "tail"],
            )

    return emit


def _flush(keys: list, ids: list[np.ndarray], key_type: pa.DataType, name: str) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
    column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    return pa.RecordBatch.from_arrays([pa.array(keys, key_type), column], names=[name, "ids"])


def _encoded(path: str, pattern: str, key: str):
    """Ids of every ``text``, in batches of bounded size."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, compiled = tokenizer(path, pattern), regex.compile(pattern)
        for batch in batches:
            key_type, keys, ids, held = batch.column(key).type, [], [], 0
            for own, text in zip(batch.column(key).to_pylist(), batch.column("text"), strict=True):
                found = np.array(encoded_pieces(text.as_py() or "", encoding, compiled), np.int32)
                keys.append(own)
                ids.append(found)
                held += len(found)
                if held > BATCH_IDS:
                    yield _flush(keys, ids, key_type, key)
                    keys, ids, held = [], [], 0
            yield _flush(keys, ids, key_type, key)

    return emit


def _long_texts(texts: DataFrame, path: str, pattern: str, size: int, overlap: int) -> DataFrame:
    """``rid, ids`` of every distinct ``rid`` of ``rid, text``."""
    chunks = texts.mapInArrow(_chunks(size, overlap), "rid string, k long, last boolean, part string")
    chunks = chunks.dropDuplicates(["rid", "k"])
    found = chunks.mapInArrow(
        _bounds(size, overlap, pattern), "rid string, k long, head array<int>, tail array<int>"
    )
    order = Window.partitionBy("rid").orderBy("k")
    common = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    cuts = found.select("rid", "k", common.alias("cut"))
    cuts = cuts.select(
        F.col("rid").alias("cut_rid"),
        F.col("k").alias("cut_k"),
        "cut",
        F.lead("cut").over(order).alias("next_cut"),
        F.count("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("piece"),
    )
    begin = F.coalesce("cut", F.lit(0))
    end = F.when(F.col("last"), F.length("part")).otherwise(
        F.lit(size) + F.coalesce("next_cut", F.lit(0))
    )
    parts = chunks.join(cuts, (F.col("rid") == F.col("cut_rid")) & (F.col("k") == F.col("cut_k")))
    part = F.substring(F.col("part"), begin + 1, end - begin)
    parts = parts.select("rid", "piece", "k", part.alias("part"))
    pieces = parts.groupBy("rid", "piece").agg(
        F.array_sort(F.collect_list(F.struct("k", "part"))).alias("parts")
    )
    named = F.to_json(F.struct("rid", "piece"))
    pieces = pieces.select(named.alias("name"), F.array_join("parts.part", "").alias("text"))
    ids = pieces.mapInArrow(_encoded(path, pattern, "name"), "name string, ids array<int>")
    own = F.from_json("name", "rid string, piece long")
    ids = ids.select(own["rid"].alias("rid"), own["piece"].alias("piece"), "ids")
    listed = F.array_sort(F.collect_list(F.struct("piece", "ids")))
    return ids.groupBy("rid").agg(F.flatten(listed["ids"]).alias("ids"))


def encode(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    then: tuple[Emitter, str] | None = None,
) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``.

    ``then``, a function of batches of these columns and the schema it gives, goes on with them where
    they arise: a short text is encoded and worked on by one Python worker, not by one after another.

    A null or empty text has no ids; no rows give no rows. Ids of documents are passed on, null or
    repeated ones too; repeated rows give repeated results. Other columns, of any name, are not read. ``path`` is a rank file that
    every executor has.
    """
    path = path or public_tokenizers.path(RANKS)
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    is_long = F.coalesce(F.length("text") > chunk + overlap, F.lit(False))
    encoded, schema = _encoded(path, pattern, "doc_id"), f"doc_id {id_type}, ids array<int>"
    go_on, given = then or ((lambda batches: batches), schema)
    short = docs.where(~is_long).mapInArrow(lambda batches: go_on(encoded(batches)), given)
    # Equal texts have equal ids, so a text stands for itself.
    long = docs.where(is_long).withColumn("rid", F.sha2("text", 256))
    ids = _long_texts(long.select("rid", "text"), path, pattern, chunk, overlap)
    names = long.select("doc_id", "rid")
    found = names.join(ids, "rid").select("doc_id", "ids")
    return short.unionByName(found.mapInArrow(go_on, given) if then else found)


def decoded(path: str, pattern: str = public_tokenizers.PATTERN) -> Emitter:
    """From ``doc_id, ids`` to the bytes, and to digests of both."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(path, pattern)  # the one that encodes, if this worker has it
        for batch in batches:
            counts, marks, texts = [], [], []
            for ids in batch.column("ids"):
                ids = ids.values.to_pylist()
                counts.append(len(ids))
                marks.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                texts.append(hashlib.sha256(encoding.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(marks, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return emit


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, bytes`` from ``doc_id, ids``; a null list gives no bytes."""
    path = path or public_tokenizers.path(RANKS)
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(path)
        for batch in batches:
            raw = [encoding.decode_bytes(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "bytes"]
            )

    return tokens.select("doc_id", "ids").mapInArrow(emit, f"doc_id {id_type}, bytes binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    A null or empty text has no tokens and the digests of nothing. Null and repeated ids, repeated
    rows and texts of any length are rows like others; columns other than ``doc_id`` and ``text`` are
    not read; no rows give no rows.
    """
    path = path or public_tokenizers.path(RANKS)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode(docs, path, then=(decoded(path), schema))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    return digests(spark.read.parquet(f"{folder}/documents.parquet"))
