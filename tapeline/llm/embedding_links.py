"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it when their inner product is at least alpha, that is, inside a cap. Directions form a
random product code: after a random rotation the coordinates are cut into blocks, each block has a small list of random unit
vectors, and every combination of one per block is a filter. So there are very many, and those a vector passes are listed by
branch and bound over the blocks without looking at the others. Two vectors are a candidate pair where they pass the same filter,
and a link when their cosine is COSINE or more. Alpha is set so that made-up pairs of just that cosine share a filter in RECALL of
the cases, the number of filters so that a filter is passed by few unrelated vectors, whatever the number of vectors. A vector
that passes few filters gets the best ones below alpha.

Equal vectors are one node with a weight. A pair that shares several filters is counted at the smallest one. Pairs of a filter
are compared in tasks of bounded size: a filter passed by many is cut into slots, and each pair of slots is a task. Large groups of
near copies would make very many pairs: of filters with more than LIMIT members the centre is computed, and members within half
the linking angle of a centre are a clique, all of whose pairs are links by the triangle inequality. They are counted without
being compared; only members outside of the clique are compared, with each other and with its members.

Defined cases: a null, empty or zero vector and one with null or non-finite components links with nothing, and so does a null id;
such a row is its own component. Vectors of different length do not link. Equal vectors link also if their ids are equal. Rows that
repeat are each answered. An empty table gives an empty result. Other columns of the input are not looked at. Vectors are told apart
by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.components import components
from tapeline.llm.tables import stored

COSINE = 0.95
RECALL = 0.99
#: Unrelated vectors that should pass a filter, about; and numbers of filters that a vector should pass, as few as give the recall.
CROWD, PASSED = 0.25, (8, 16, 24, 32, 48, 64, 96, 128, 192, 256)
#: Members of a slot.
LIMIT = 1_000
BLOCKS = 4
WORDS = (4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
_STEP = 0.01
_ROWS = 1_000
_NO_CLIQUE = -1
#: Angles this close to the bound are compared, not taken for granted.
_MARGIN = 1e-6


@dataclass
class Code:
    """Filters for vectors of ``size`` components: a rotation, and unit vectors of each block (blocks, words, width)."""

    size: int
    rotation: np.ndarray
    words: np.ndarray
    alpha: float = 1.0
    least: int = 1
    found: float = 0.0

    @classmethod
    def of(cls, size: int, words: int, seed: int = 5) -> Code:
        random = np.random.default_rng([seed, size])
        blocks = min(BLOCKS, max(1, size // 4))
        width = -(-size // blocks)
        rotation = np.linalg.qr(random.normal(size=(blocks * width, blocks * width)))[0]
        listed = random.normal(size=(blocks, words, width))
        return cls(size, rotation, listed / np.linalg.norm(listed, axis=2, keepdims=True))

    @classmethod
    def fit(cls, size: int, n: int, cosine: float = COSINE, recall: float = RECALL, crowd: float = CROWD, seed: int = 5) -> Code:
        """A code whose filters are passed by about ``crowd`` of ``n`` unrelated vectors, where a vector passes as few filters (at least,
        and on average or more) as give the recall. ``found`` is the recall on made-up pairs of just that cosine."""
        random = np.random.default_rng([seed + 1, size])
        left = _units(random.normal(size=(_ROWS, size)))
        across = random.normal(size=left.shape)
        across -= (across * left).sum(1, keepdims=True) * left
        right = cosine * left + np.sqrt(1 - cosine**2) * _units(across + 1e-12)
        blocks = len(cls.of(size, 1, seed).words)
        words = next((x for x in WORDS if x**blocks * crowd >= n * PASSED[1]), WORDS[-1])
        code = cls.of(size, words, seed)
        scale = words**blocks
        inner, which = code._inner(left), np.arange(_ROWS)
        code.alpha = float(inner.max(2).sum(1).max())
        for code.least in PASSED:
            while code.alpha > -1 and len(code._listed(inner, np.full(_ROWS, code.alpha), which)[0]) < min(code.least, scale) * _ROWS:
                code.alpha -= _STEP
            sides = [code.passed(x) for x in (left, right)]
            shared = np.intersect1d(*(rows * scale + ids for rows, ids in sides))
            code.found = len(np.unique(shared // scale)) / _ROWS
            if code.found >= recall:
                break
        return code

    def passed(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (vector, filter), by vector and filter."""
        parts = [self._passed(units[a : a + _ROWS]) for a in range(0, len(units), _ROWS)]
        rows = [np.concatenate([rows + a * _ROWS for a, (rows, _) in enumerate(parts)]) if parts else np.zeros(0, np.int64)]
        ids = np.concatenate([x for _, x in parts]) if parts else np.zeros(0, np.int64)
        order = np.lexsort((ids, rows[0]))
        return rows[0][order], ids[order]

    def _passed(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inner = self._inner(units)
        alpha = np.full(len(units), self.alpha)
        rows, ids = self._listed(inner, alpha, np.arange(len(units)))
        while True:  # vectors with few filters: those in a wider cap
            few = np.flatnonzero(np.bincount(rows, minlength=len(units)) < min(self.least, self.words.shape[1] ** len(self.words)))
            if not len(few):
                return rows, ids
            alpha[few] -= _STEP
            more, wider = self._listed(inner, alpha, few)
            keep = ~np.isin(rows, few)
            rows, ids = np.r_[rows[keep], more], np.r_[ids[keep], wider]

    def _inner(self, units: np.ndarray) -> np.ndarray:
        """Inner products with the words of each block (vector, block, word)."""
        blocks, _, width = self.words.shape
        turned = np.pad(units, ((0, 0), (0, blocks * width - units.shape[1]))) @ self.rotation
        return np.einsum("nkw,kbw->nkb", turned.reshape(-1, blocks, width), self.words, optimize=True) / np.sqrt(blocks)

    def _listed(self, inner: np.ndarray, alpha: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Branch and bound: a choice of words is followed up while the best words of the blocks left can still reach alpha."""
        best = inner.max(2)
        rows, total, ids = which, np.zeros(len(which)), np.zeros(len(which), np.int64)
        for k in range(inner.shape[1]):
            rest = best[:, k + 1 :].sum(1)
            at, word = np.nonzero(inner[rows, k] >= (alpha[rows] - rest[rows] - total)[:, None])
            total = total[at] + inner[rows[at], k, word]
            ids = ids[at] * inner.shape[2] + word
            rows = rows[at]
        return rows, ids


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(vector: str) -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """Unit vectors, in double precision, of rows of ``size`` components."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    vectors = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return _units(vectors / np.abs(vectors).max(1, keepdims=True))


def filtered(nodes: DataFrame, codes: dict[int, Code]) -> DataFrame:
    """Rows (node, size, filters) of nodes (node, vector)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column(1)).to_numpy()
            for size in np.unique(sizes).tolist():
                taken = pa.array(np.flatnonzero(sizes == size))
                nodes_here, vectors = (batch.column(k).take(taken) for k in (0, 1))
                rows, ids = codes[size].passed(_matrix(vectors, size))
                offsets = np.searchsorted(rows, np.arange(len(taken) + 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([nodes_here, pa.array([size] * len(taken), pa.int32()), lists], names=["node", "size", "filters"])

    return nodes.select("node", "vector").mapInArrow(decode, "node long, size int, filters array<long>")


def cliques(members: DataFrame, crowds: DataFrame, cosine: float, limit: int) -> DataFrame:
    """Rows (node, clique): members of crowded filters within half the linking angle of a filter's centre. ``members`` (size, filter,
    node, vector), ``crowds`` (size, filter, n)."""
    half = np.arccos(cosine) / 2 - _MARGIN
    here = members.join(crowds, ["size", "filter"])

    def total(group: pa.Table) -> pa.Table:
        return pa.table({"size": group["size"][:1], "filter": group["filter"][:1], "centre": pa.array([_matrix(group["vector"], group["size"][0].as_py()).sum(0).tolist()])})

    cell = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / limit)).alias("cell")
    parts = here.select("size", "filter", "vector", cell).groupBy("size", "filter", "cell").applyInArrow(total, "size int, filter long, centre array<double>")
    parts = parts.select("size", "filter", F.posexplode("centre").alias("at", "x")).groupBy("size", "filter", "at").agg(F.sum("x").alias("x"))
    centres = parts.groupBy("size", "filter").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda e: e["x"]).alias("centre"))  # as many as components
    centres = centres.where(F.exists("centre", lambda x: x != 0))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            inside = np.zeros(batch.num_rows, bool)
            for size in np.unique(sizes).tolist():
                which = np.flatnonzero(sizes == size)
                units, middles = (_matrix(batch.column(k).take(pa.array(which)), size) for k in (3, 4))
                inside[which] = (units * middles).sum(1) >= np.cos(half)
            yield batch.select([2, 1, 5]).filter(pa.array(inside))

    placed = here.join(centres, ["size", "filter"]).select("size", "filter", "node", "vector", "centre", "n")
    core = placed.mapInArrow(near, "node long, filter long, n long")
    # the most crowded filter, so that few cliques hold most members
    best = core.groupBy("node").agg(F.max(F.struct("n", (-F.col("filter")).alias("filter"))).alias("best"))
    return best.select("node", (-F.col("best.filter")).alias("clique"))


def dealt(members: DataFrame, limit: int) -> DataFrame:
    """Members (size, filter, node, weight, clique, vector) dealt to tasks (filter, i, j): of each filter, the members of its most
    frequent clique meet the others, the others meet each other."""
    counts = members.groupBy("size", "filter", "clique").agg(F.count("*").alias("n"))
    main = counts.groupBy("size", "filter").agg(F.max(F.struct(F.when(F.col("clique") != _NO_CLIQUE, F.col("n")).alias("n"), "clique")).alias("main"), F.sum("n").alias("n"))
    inside = F.coalesce("main.n", F.lit(0))
    slots = main.select(
        "size",
        "filter",
        F.when(F.col("main.n").isNotNull(), F.col("main.clique")).otherwise(F.lit(None)).alias("main"),
        F.ceil(inside / limit).cast("int").alias("n_in"),
        F.ceil((F.col("n") - inside) / limit).cast("int").alias("n_out"),
    ).where("n_out > 0")
    both = members.join(slots, ["size", "filter"])
    is_in = F.col("clique").eqNullSafe(F.col("main"))
    slot = F.pmod(F.xxhash64("node"), F.when(is_in, F.col("n_in")).otherwise(F.col("n_out"))).cast("int")
    both = both.select("*", is_in.alias("is_in"), slot.alias("slot"))
    # slots of the others are numbered from 0 on, those of the clique from n_out on
    others = F.sequence(F.lit(0), F.col("n_out") - 1)
    within = F.when(F.col("n_in") > 0, F.sequence(F.col("n_out"), F.col("n_out") + F.col("n_in") - 1)).otherwise(F.array().cast("array<int>"))
    mine = F.when(F.col("is_in"), F.col("n_out") + F.col("slot")).otherwise(F.col("slot"))
    meets = F.explode(F.when(F.col("is_in"), others).otherwise(F.concat(others, within)))
    both = both.select("size", "filter", "node", "weight", "clique", "vector", mine.alias("slot"), meets.alias("other"))
    return both.select("size", "filter", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "slot", "node", "weight", "clique", "vector")


def _first_shared(owner: np.ndarray, filters: np.ndarray, n: int, at: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the vectors ``left`` and ``right``, of ``n`` that pass ``filters`` (of ``owner``), share none below ``at``."""
    below = filters < at
    owner = owner[below]
    found, column, count = np.unique(filters[below], return_inverse=True, return_counts=True)
    several = np.flatnonzero(count > 1)
    place = np.full(len(found), -1)
    place[several] = np.arange(len(several))
    column = place[column]
    shared = np.zeros((n, n), np.float32)
    for a in range(0, len(several), 2_048):
        here = (column >= a) & (column < a + 2_048)
        holds = np.zeros((n, min(2_048, len(several) - a)), np.float32)
        holds[owner[here], column[here] - a] = 1
        shared += holds @ holds.T
    return shared[left, right] == 0


def _lowest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` places, the smallest one that links reach."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[left], low[right])
        before = low.copy()
        np.minimum.at(low, left, least)
        np.minimum.at(low, right, least)
        low = low[low]
        if (low == before).all():
            return low


def compared(tasks: DataFrame, codes: dict[int, Code], cosine: float = COSINE) -> DataFrame:
    """Rows (node, links, other): weights of the linked members that are counted in a task, and a member it is connected with there."""

    def group(rows: pa.Table, units: np.ndarray) -> pa.RecordBatch:
        slot, clique = rows["slot"].to_numpy(), rows["clique"].to_numpy()
        left, right = np.nonzero(np.triu(units @ units.T >= cosine, 1))
        keep = (clique[left] != clique[right]) | (clique[left] == _NO_CLIQUE)
        if rows["i"][0] != rows["j"][0]:
            keep &= slot[left] != slot[right]
        left, right = left[keep], right[keep]
        linked, place = np.unique(np.r_[left, right], return_inverse=True)
        left, right = place[: len(left)], place[len(left) :]
        node, weight = (rows[x].to_numpy()[linked] for x in ("node", "weight"))
        links = np.zeros(len(node), np.int64)
        if len(left):
            owner, filters = codes[units.shape[1]].passed(units[linked])
            mine = _first_shared(owner, filters, len(node), rows["filter"][0].as_py(), left, right)
            np.add.at(links, left[mine], weight[right[mine]])
            np.add.at(links, right[mine], weight[left[mine]])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, links, node[_lowest(len(node), left, right)])], names=["node", "links", "other"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None  # the task at the end of a batch may go on in the next one; it has two slots at most
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
            marks = np.column_stack([rows[x].to_numpy() for x in ("size", "filter", "i", "j")])
            cuts = np.r_[0, np.flatnonzero((np.diff(marks, axis=0) != 0).any(1)) + 1].tolist()
            yield from _tasks(rows, cuts)
            left = rows.slice(cuts[-1]).combine_chunks()
        if left is not None and left.num_rows:
            yield from _tasks(left, [0, left.num_rows])

    def _tasks(rows: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        sizes, marks = rows["size"].to_numpy(), np.array(cuts)
        for size in np.unique(sizes[cuts[:-1]]).tolist():  # tasks of one length follow each other
            chosen = np.flatnonzero(sizes == size)
            chosen = chosen[chosen < cuts[-1]]
            first = int(chosen[0])
            units = _matrix(rows["vector"].slice(first, len(chosen)), size)
            for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
                if sizes[a] == size and b - a > 1:
                    held = units[a - first : b - first]
                    # most tasks are small: is there any link at all?
                    if b - a > 24 or ((held @ held.T) >= cosine).sum() > b - a:
                        yield group(rows.slice(a, b - a).combine_chunks(), held)

    by = ["size", "filter", "i", "j"]
    return tasks.repartition(*by).sortWithinPartitions(*by).mapInArrow(compare, "node long, links long, other long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, recall: float = RECALL, limit: int = LIMIT) -> DataFrame:
    """Per row: ``key``, n_links, component_id, kept."""
    kind = vectors.schema[key].dataType.simpleString()
    linkable = usable(vector) & F.col(key).isNotNull()
    rows = vectors.select(F.col(key).alias("id"), F.when(linkable, F.xxhash64(F.size(vector), vector)).alias("node"), F.col(vector).alias("vector"))
    grouped = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.any_value("vector").alias("vector"))
    nodes = stored(grouped, "nodes")
    sizes = {row["size"]: row["n"] for row in nodes.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).collect()}
    codes = {size: Code.fit(size, n, cosine, recall) for size, n in sizes.items()}
    ready = stored(filtered(nodes, codes), "filtered")
    listed = ready.select("size", "node", F.explode("filters").alias("filter"))
    shared = stored(listed.groupBy("size", "filter").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    by = ["size", "filter"]
    members = stored(listed.join(shared.select(*by), by, "left_semi"), "members")
    crowds = shared.where(F.col("n") > limit)
    none = F.lit(_NO_CLIQUE).cast("long")
    known, clique = nodes.select("node", "weight", "vector", none.alias("clique")), None
    if not crowds.isEmpty():
        crowded = members.join(crowds.select(*by), by, "left_semi").join(known.select("node", "vector"), "node")
        clique = stored(cliques(stored(crowded, "crowded"), crowds, cosine, limit), "cliques")
        known = known.drop("clique").join(clique, "node", "left").withColumn("clique", F.coalesce("clique", none))
    found = stored(compared(dealt(members.join(known, "node"), limit), codes, cosine), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("node").alias("a"), F.col("other").alias("b"))
    result = nodes.select("node", "id", "weight").join(links, "node", "left").withColumn("links", F.coalesce("links", F.lit(0)) + F.col("weight") - 1)
    if clique is not None:
        within = clique.join(nodes.select("node", "weight"), "node")
        total = within.groupBy("clique").agg(F.sum("weight").alias("total"), F.min("node").alias("low"))
        within = stored(within.join(total, "clique").select("node", "low", (F.col("total") - F.col("weight")).alias("more")), "within")
        edges = edges.unionAll(within.select(F.col("node").alias("a"), F.col("low").alias("b")))
        result = result.join(within.select("node", "more"), "node", "left").withColumn("links", F.col("links") + F.coalesce("more", F.lit(0)))
    result = stored(result.join(components(edges.distinct()), "node", "left").withColumn("component", F.coalesce("component", "node")), "result")
    lowest = result.groupBy("component").agg(F.min("id").alias("low"))
    result = result.join(lowest, "component").select("node", "links", "low")
    answered = rows.select("id", "node").join(result, "node", "left")
    component = F.coalesce("low", "id").cast(kind)
    return answered.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def oracle(cosine: float = COSINE) -> str:
    """The same result over ``embeddings`` in SQL, all pairs compared; for small tables."""
    return f"""
    with recursive vectors as (
      select vec_id, embedding::double[] as v,
             sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as norm
      from embeddings
      where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), links as (
      select a.vec_id as x, b.vec_id as y
      from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
      where a.norm > 0 and b.norm > 0 and list_dot_product(a.v, b.v) / (a.norm * b.norm) >= {cosine}
    ), reached as (
      select vec_id, vec_id as other from embeddings
      union select reached.vec_id, y from reached join links on x = other
    ), smallest as (
      select vec_id, min(other) as component_id from reached group by vec_id
    ), counted as (
      select x, count(*) as n from links group by x
    )
    select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
    from smallest left join counted on x = vec_id
    """
