"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, exact rerank.

*Codes.* On a bounded sample of vectors a rotation is learnt that puts the principal directions
as near as possible to the corners of a cube; the signs of a rotated vector are its bits. Several
rotations from different starts give a word of bits each. How many it takes, and in how many bits
linked vectors differ, is measured on pairs planted around the sample at exactly the least cosine:
centred vectors differ by a larger angle than raw ones where all share a direction. Rotations are
added until tables and radius miss ``MISSED`` of these pairs at most; if ``MOST_ROTATIONS`` do not,
all vectors are one candidate group.

*Tables.* Every code is cut into substrings, one table each. They have ``SUBSTRING`` bits or more, at
most as many as the number of vectors: long ones keep places small however many vectors there are,
but need more rotations, so the length with the least work is taken. Two vectors meet
in a table if their substrings differ in one bit at most: a vector is filed under its substring and
probes those with one of its zeros turned into a one, so a pair that differs in one bit meets
once. Where vectors meet, their whole codes are compared, and pairs within the radius join one
candidate group. Only links to the smallest such partner leave a task.

*Rerank.* In each candidate group all vectors are compared by cosine in double precision, in blocks
of ``BLOCK`` vectors. Only counts and a spanning forest of the links leave a task. Equal vectors
are one vector with a weight and a number. Meetings and groups of more than a block are dealt out as pairs of
blocks, so no task gets an unbounded group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import stored
from wardline.llm.components import components

LEAST_COSINE = 0.95
ROTATIONS = 3
MOST_ROTATIONS = 16
MISSED = 0.001
SUBSTRING = 16
LONGEST = 32
SAMPLE = 4_000
VECTORS_A_DIMENSION = 8
BLOCK = 1_024
SMALL = 48
# So few vectors of a length are compared without codes: there is nothing to learn from them.
FEW = 64


def learn(
    sample: np.ndarray, rotations: int = ROTATIONS, rounds: int = 40, width: int = SUBSTRING
) -> list[tuple]:
    """``(mean, projection)`` of each rotation, from unit vectors as rows."""
    mean = sample.mean(axis=0)
    x = sample - mean
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    bits = min(64, len(axes) - len(axes) % width) or len(axes)
    axes = axes[:bits].T
    v, found = x @ axes, []
    for k in range(rotations):
        rotation, _ = np.linalg.qr(np.random.default_rng(k).normal(size=(bits, bits)))
        for _ in range(rounds):
            corners = np.where(v @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(corners.T @ v)
            rotation = (left @ right).T
        found.append((mean, axes @ rotation))
    return found


def encode(x: np.ndarray, model: list[tuple]) -> np.ndarray:
    """A 64-bit word for each vector and rotation."""
    out = np.zeros((len(x), len(model)), np.uint64)
    for k, (mean, projection) in enumerate(model):
        bits = (x - mean) @ projection >= 0
        for b in range(bits.shape[1]):
            out[:, k] |= bits[:, b].astype(np.uint64) << np.uint64(b)
    return out


def planted(sample: np.ndarray, least: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors of exactly the least cosine around the sample.

    They differ in any direction in the first list, and as vectors of the sample do in the second.
    """
    rng = np.random.default_rng(0)
    x = np.resize(sample, (max(SAMPLE, len(sample)), sample.shape[1]))
    others = [sample[rng.integers(len(sample), size=len(x))] for _ in range(2)]
    pairs = []
    for u in (rng.normal(size=x.shape), others[0] - others[1]):
        u = u - (u * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(u, axis=1)
        some = size > 1e-9
        y = least * x[some] + np.sqrt(1 - least**2) * u[some] / size[some, None]
        if some.any():
            pairs.append((x[some], y))
    return pairs


def widths(n: int) -> list[int]:
    """Lengths of substrings to choose from for ``n`` vectors."""
    best = min(LONGEST, max(SUBSTRING, n.bit_length()))
    return [*range(SUBSTRING, best, 3), best]


def work(model: list[tuple], width: int, n: int) -> float:
    """Rows that a vector is filed as, and other vectors that it meets there."""
    tables = len(model) * max(1, model[0][1].shape[1] // width)
    return tables * (1 + width / 2) * (1 + n / 2**width)


def substrings(code: np.ndarray, bits: int, width: int) -> Iterator[np.ndarray]:
    """The substrings of one column of words, a table each; a code shorter than one is one."""
    for at in range(0, max(width, bits // width * width), width):
        yield (code >> np.uint64(at)) & np.uint64((1 << width) - 1)


def fit(sample: np.ndarray, least: float, width: int = SUBSTRING) -> tuple[list[tuple], int] | None:
    """The fewest rotations, and the radius, that find planted pairs; none if too many are missed.

    Codes fit the vectors they are learnt from better than others, so half of the sample learns and
    pairs are planted around the other half. A sample of few vectors a dimension does both as a whole.
    """
    held, half = sample, len(sample) // 2
    if half >= VECTORS_A_DIMENSION * sample.shape[1]:
        sample, held = sample[:half], sample[half:]
    pairs = planted(held, least)
    for most in (ROTATIONS, MOST_ROTATIONS):
        model = learn(sample, most, width=width)
        bits = model[0][1].shape[1]
        codes = [encode(x, model) ^ encode(y, model) for x, y in pairs]
        # In how many bits the nearest substring of each rotation differs.
        nearest = [
            np.stack([np.min([np.bitwise_count(p) for p in substrings(w, bits, width)], axis=0) for w in c.T])
            for c in codes
        ]
        for n in range(ROTATIONS, most + 1):
            differ = [np.ascontiguousarray(c[:, :n]) for c in codes]
            far = [np.bitwise_count(d).sum(axis=1, dtype=np.int64) for d in differ]
            # The mean and four and a half deviations more, and what was seen at least.
            limit = max([max(int(np.ceil(f.mean() + 4.5 * f.std() + 1)), int(f.max())) for f in far], default=0)
            if all((p[:n].min(axis=0) > 1).mean() <= MISSED for p in nearest):
                return model[:n], limit
    return None


def _usable(column: pa.Array) -> tuple[list, np.ndarray]:
    """The rows as arrays, and which of them can link."""
    rows = column.to_pylist()
    ok = np.array([r is not None and len(r) > 0 and None not in r for r in rows], bool)
    arrays = [np.array(r, float) if good else None for r, good in zip(rows, ok, strict=True)]
    for k in np.flatnonzero(ok):
        ok[k] = bool(np.isfinite(arrays[k]).all()) and bool(np.abs(arrays[k]).max() > 0)
    return arrays, ok


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, name, unit``: the bytes of the unit vector, none for a vector that cannot link."""
    for batch in batches:
        arrays, ok = _usable(batch.column("embedding"))
        units, names = [], []
        for k, good in enumerate(ok):
            x = arrays[k] / np.abs(arrays[k]).max() if good else None
            units.append((x / np.sqrt(x @ x)).tobytes() if good else None)
            names.append(hashlib.md5(arrays[k].tobytes()).hexdigest() if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(names, pa.string()), pa.array(units, pa.binary())],
            names=["vec_id", "name", "unit"],
        )


def _filed(model: list[tuple], width: int):
    """Rows of the tables: ``place`` (table and substring), ``probe``, ``key`` and the code."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = len(model[0][0])
        for batch in batches:
            keys = batch.column("key")
            x = np.array([np.frombuffer(b, float) for b in batch.column("unit").to_pylist()])
            if not len(x):
                continue
            code = encode(x.reshape(-1, dims), model)
            words = [pa.array(code[:, k].view(np.int64)) for k in range(code.shape[1])]
            table = 0
            for k in range(code.shape[1]):
                for own in substrings(code[:, k], model[k][1].shape[1], width):
                    own = own.astype(np.int64)
                    for bit in range(-1, width):
                        who = np.arange(len(own)) if bit < 0 else np.flatnonzero(~own >> bit & 1)
                        place = own[who] | (0 if bit < 0 else 1 << bit)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(place + (table << width)),
                                pa.array(np.full(len(who), bit >= 0)),
                                keys.take(pa.array(who)),
                                *[w.take(pa.array(who)) for w in words],
                            ],
                            names=["place", "probe", "key", *[f"w{i}" for i in range(len(words))]],
                        )
                    table += 1

    return emit


def _by_group(work: Callable[[list[pa.Array]], Iterator[pa.RecordBatch]], columns: list[str]):
    """Apply ``work`` to whole groups of a sorted stream; the first two columns name the group.

    Rows are held until the group they belong to is complete.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch]).select(columns)
            held = part if held is None else pa.concat_tables([held, part])
            a, b = (held.column(c).combine_chunks() for c in columns[:2])
            n = len(held)
            if n < 2:
                continue
            same = np.array(
                pc.and_(pc.equal(a[1:], a[:-1]), pc.equal(b[1:], b[:-1]))
            )
            new = np.flatnonzero(~same)
            if len(new):
                cut = int(new[-1]) + 1
                yield from work(held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
        if held is not None and len(held):
            yield from work(held.combine_chunks())

    return emit


def _starts(table: pa.Table, columns: list[str]) -> np.ndarray:
    new = np.ones(len(table), bool)
    for k, c in enumerate(columns):
        x = table.column(c).combine_chunks()
        differs = np.array(pc.not_equal(x[1:], x[:-1]))
        new[1:] = differs if not k else new[1:] | differs
    return np.flatnonzero(new)


def _links(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _forest(close: np.ndarray) -> np.ndarray:
    """The label, smallest index connected, of every row of a symmetric boolean matrix."""
    label = np.arange(len(close))
    while True:
        near = np.where(close, label[None, :], len(close)).min(axis=1)
        lower = np.minimum(label, near)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _meet(words: int, limit: int):
    """Links of vectors that meet and whose codes are within the limit."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.array(table.column("key"))
        probe = np.array(table.column("probe"))
        block = np.array(table.column("block"))
        cell = np.array(table.column("cell"))
        cross = crosses(cell)
        code = np.stack([np.array(table.column(f"w{i}")).view(np.uint64) for i in range(words)], axis=1)
        starts = _starts(table, ["place", "cell"])
        sizes = np.diff(np.append(starts, len(table)))
        group = np.repeat(np.arange(len(starts)), sizes)
        small = (sizes <= SMALL)[group]
        found = [[], []]
        for lag in range(1, SMALL):
            i = np.flatnonzero(small[:-lag] & (group[lag:] == group[:-lag]))
            if not len(i):
                break
            j = i + lag
            some = ~(probe[i] & probe[j]) & ~(cross[i] & (block[i] == block[j]))
            i, j = i[some], j[some]
            far = np.bitwise_count(code[i] ^ code[j]).sum(axis=1, dtype=np.int64)
            found[0].append(i[far <= limit])
            found[1].append(j[far <= limit])
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in found)
        if len(a):
            pairs = np.unique(np.stack([keys[a], keys[b]]), axis=1)
            yield from _links(pairs[0], pairs[1])
        for k in np.flatnonzero(sizes > SMALL):
            at = np.arange(starts[k], starts[k] + sizes[k])
            far = np.zeros((len(at), len(at)), np.int16)
            for w in range(words):
                far += np.bitwise_count(code[at, w][:, None] ^ code[at, w][None, :])
            close = (far <= limit) & ~(probe[at][:, None] & probe[at][None, :])
            close &= ~(cross[at][:, None] & (block[at][:, None] == block[at][None, :]))
            label = _forest(close)
            moved = np.flatnonzero(label != np.arange(len(at)))
            yield from _links(keys[at[moved]], keys[at[label[moved]]])

    return work


def _rerank(least: float):
    """``key, links, partner`` of the vectors of each pair of blocks of a candidate group."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        starts = np.append(_starts(table, ["place", "cell"]), len(table))
        block, cell = np.array(table.column("block")), np.array(table.column("cell"))
        n = np.array(table.column("n"))
        keys, units = np.array(table.column("key")), table.column("unit").to_pylist()
        for low, high in zip(starts[:-1], starts[1:], strict=True):
            lengths = np.array([len(units[k]) for k in range(low, high)])
            for length in np.unique(lengths):
                at = low + np.flatnonzero(lengths == length)
                x = np.array([np.frombuffer(units[k], float) for k in at])
                close = x @ x.T >= least
                np.fill_diagonal(close, False)
                if crosses(cell[low]):
                    close &= block[at][:, None] != block[at][None, :]
                label = _forest(close)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[at]),
                        pa.array((close @ n[at]).astype(np.int64)),
                        pa.array(keys[at[label]]),
                    ],
                    names=["key", "links", "partner"],
                )

    return work


def cell_of(block: str, other: str) -> Column:
    """The cell of two blocks, in either order."""
    low, high = (pick(block, other).cast("long") for pick in (F.least, F.greatest))
    return F.shiftleft(low, 32).bitwiseOR(high)


def crosses(cell: np.ndarray) -> np.ndarray:
    """Whether a cell is of two blocks; their numbers are its upper and lower 32 bits."""
    return cell >> 32 != cell & 0xFFFFFFFF


def in_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Deal rows of each ``place`` into cells: pairs of blocks of about ``block`` rows.

    Adds ``block`` and ``cell``. A place of one block is one cell; in a larger one each row goes to
    every cell its block is in, and two rows of different blocks meet in one cell.
    """
    sizes = rows.groupBy("place").agg(F.count(F.lit(1)).alias("size"))
    large = stored(sizes.where(F.col("size") > block), "large")
    large = large.select(
        F.col("place").alias("large"), F.ceil(F.col("size") / block).cast("int").alias("blocks")
    )
    dealt = rows.join(large, F.col("place") == F.col("large"), "left")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    dealt = dealt.select("*", other)
    return dealt.withColumn("cell", cell_of("block", "other")).drop("large", "blocks", "other")


def sorted_cells(rows: DataFrame) -> DataFrame:
    return rows.repartition("place", "cell").sortWithinPartitions("place", "cell")


def near_duplicates(
    vectors: DataFrame, least: float = LEAST_COSINE, few: int = FEW, width: int | None = None
) -> DataFrame:
    """One row per row of ``vec_id, embedding``: ``vec_id, n_links, component_id, kept``.

    A vector that is null, empty or zero or holds a null or non-finite component links with
    nothing and is its own component; so do vectors of different lengths. Equal vectors link.
    ``n_links`` counts rows, so a repeated row is a link. A null id is never the smallest of a
    component that has another; a component of null ids alone is null, and its rows are kept.
    Each length has its own codes; the vectors of a length that at most ``few`` have are all compared.
    ``width`` is the number of bits of a substring, by default what suits the number of vectors.
    Other columns are not read; no rows give no rows.
    """
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    rows = stored(
        vectors.select("vec_id", "embedding").mapInArrow(
            _units, f"vec_id {id_type}, name string, unit binary"
        ),
        "units",
    )
    groups = rows.where("name IS NOT NULL").groupBy("name").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("unit").alias("unit")
    )
    # Numbers are given once and stored; a task that runs again writes its part anew.
    groups = stored(groups.withColumn("key", F.monotonically_increasing_id()), "vectors")
    size = F.octet_length("unit")
    counted = {r[0]: r[1] for r in groups.groupBy(size).count().collect()}
    many = sorted(k for k, n in counted.items() if n > few)
    linked = []
    if len(many) < len(counted):
        few = groups.where(~size.isin(many)).select(size.cast("string").alias("place"), "key", "n", "unit")
        linked.append(_ranked(few, least))
    draw = F.pmod(F.xxhash64("name"), F.lit(1 << 30)) / float(1 << 30)
    for k in many:
        own = groups.where(size == k)
        sample = own.where(draw < SAMPLE / counted[k]).orderBy("name").select("unit").collect()
        sample = np.array([np.frombuffer(r[0], float) for r in sample])
        choice = widths(counted[k]) if width is None else [width]
        linked.append(_linked(own, sample, least, choice, counted[k]))
    if not linked:
        found = groups.select("key", F.lit(0).cast("long").alias("links"), F.col("first").alias("least"))
    else:
        counts, labels = (reduce(DataFrame.unionByName, frames) for frames in zip(*linked, strict=True))
        parts = groups.join(labels, F.col("key") == F.col("id"), "left").withColumn(
            "part", F.coalesce("component", "key")
        )
        firsts = parts.groupBy(F.col("part").alias("of")).agg(F.min("first").alias("least"))
        found = (
            parts.join(counts, F.col("key") == F.col("counted"), "left")
            .join(firsts, F.col("part") == F.col("of"))
            .select("key", F.coalesce("links", F.lit(0)).alias("links"), "least")
        )
    sizes = groups.select(F.col("key").alias("sized"), "name", "n")
    found = found.join(sizes, F.col("key") == F.col("sized")).select(
        F.col("name").alias("own"), (F.col("links") + F.col("n") - 1).alias("n_links"), "least"
    )
    joined = rows.join(found, F.col("name") == F.col("own"), "left")
    component = F.when(F.col("own").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _linked(
    groups: DataFrame, sample: np.ndarray, least: float, choice: list[int], n: int
) -> tuple[DataFrame, DataFrame]:
    """Weighted link counts, and the component of every one of ``n`` vectors that has a link.

    Substrings have the length of ``choice`` that finds planted pairs with the least work.
    """
    fits = [(*found, width) for width in choice if (found := fit(sample, least, width))]
    if not fits:
        return _ranked(groups.select(F.lit("").alias("place"), "key", "n", "unit"), least)
    model, limit, width = min(fits, key=lambda f: work(f[0], f[2], n))
    words = len(model)
    code = ", ".join(f"w{i} long" for i in range(words))
    names = ["place", "cell", "block", "probe", "key", *[f"w{i}" for i in range(words)]]
    filed = groups.select("key", "unit").mapInArrow(
        _filed(model, width), f"place long, probe boolean, key long, {code}"
    )
    meetings = sorted_cells(in_blocks(filed)).select(*names)
    pairs = meetings.mapInArrow(_by_group(_meet(words, limit), names), "a long, b long")
    candidates = components(pairs)
    rows = groups.join(candidates, F.col("key") == F.col("id")).select(
        F.col("component").alias("place"), "key", "n", "unit"
    )
    return _ranked(rows, least)


def _ranked(rows: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """The same of rows that are compared with all of their ``place``."""
    names = ["place", "cell", "block", "key", "n", "unit"]
    ranked = stored(
        sorted_cells(in_blocks(rows)).select(*names).mapInArrow(
            _by_group(_rerank(least), names), "key long, links long, partner long"
        ),
        "ranked",
    )
    counts = ranked.groupBy(F.col("key").alias("counted")).agg(F.sum("links").alias("links"))
    labels = components(ranked.select(F.col("key").alias("a"), F.col("partner").alias("b")))
    return counts, labels


def op7_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_inner_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) n USING (vec_id)
JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) c USING (vec_id)
"""
