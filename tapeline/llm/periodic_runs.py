"""Periodic runs of words, found in tiles per period octave and stitched over documents.

A run is a stretch of words with smallest period q, at least max(LEAST, EXPONENT * q) long, that no neighbouring word extends
with that period. Periods are worked on by octave, P to 2P - 1. In an octave every multiple of P is the boundary of a tile that
reaches 2P words to its left and 4P to its right, so tiles overlap. Each tile is solved by itself: the Z-function of the words
from the boundary on, and that of the reversed words before it, tell for all periods of the octave at once how far words q
apart are equal on both sides of the boundary. What comes out of a tile is a fragment (document, period, start, end); fragments
are shuffled by document and period and stitched where they overlap by a period. Any run is covered by fragments that chain so,
because it is four periods long and boundaries are at most one apart. Of stitched intervals that are equal, the one of smallest
period is the run: a multiple of a run's period spans the same words.

Tiles are only solved where the first words after the boundary repeat at the period, which one array comparison per octave tells
for all documents of a batch. Fragments of a document are joined in the task before they are sent, and those too short for a run
or of a multiple of another's period stay where the task saw the whole document. Documents above LONG_BYTES are exploded into rows of tiles that are dealt over the
cluster, so that a very long text is not one task's work. Words are compared by 64-bit hashes.

Defined cases: null and empty texts and texts without words have no words and no runs. A null id is not altered by ``planted``.
Rows that repeat are each answered, and so are rows of one id with different texts. An empty table gives an empty result. Other
columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.tables import stored
from tapeline.llm.texts import Texts, slabs

LEAST = 6
EXPONENT = 4
#: A tile's reach to the left and to the right of its boundary, in units of the octave's smallest period.
LEFT, RIGHT = 2, 4
#: Words after the boundary that must repeat before a tile is solved; at most the smallest period.
FIRST_WORDS = 4
#: Texts above this are exploded into rows of tiles with boundaries over so many words.
LONG_BYTES = 8 << 20
ROW_WORDS = 1 << 16

_STRIDE = np.int64(1) << 40

#: Which original word stands at each place, for a document of so many words; None where nothing changes.
Planting = Callable[[object, int], "np.ndarray | None"]


def planted(key: object, n: int) -> np.ndarray | None:
    """The agreed alteration: of one document in ten, the words from some place on repeat periodically."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def z_function(w: list[int]) -> list[int]:
    """For each place, how many words from there on equal those from the beginning on."""
    n = len(w)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and w[k] == w[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def tile(words: np.ndarray, boundary: int, periods: list[int], octave: int) -> list[tuple[int, int, int]]:
    """(period, start, end) around ``boundary`` of all ``periods``, at least two periods long; places within ``words``."""
    low, high = max(0, boundary - LEFT * octave), min(len(words), boundary + RIGHT * octave)
    after = z_function(words[boundary:high].tolist())
    upto = min(high, boundary + 2 * octave)
    back = words[low:boundary][::-1].tolist()
    before = z_function([*back, None, *words[low:upto][::-1].tolist()])
    found = []
    for q in periods:
        if boundary + q >= high:
            continue
        start = boundary - min(before[len(back) + 1 + upto - boundary - q], len(back))
        end = boundary + q + after[q]
        if end - start >= 2 * q:
            found.append((q, start, end))
    return found


def solved(words: np.ndarray, octave: int, at: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Fragments of one octave, rows of (piece, period, start, end) in places of the documents.

    Piece i holds the words of a document of ``n[i]`` words from place ``first[i]`` on, in ``words`` from ``at[i]``; tiles with a
    boundary from ``low[i]`` to ``high[i]`` are solved.
    """
    count = np.maximum(np.minimum(high, n - octave) - low, 0)
    piece = np.repeat(np.arange(len(count)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
    shift = place % octave
    begin = (at - first)[piece]
    left, right = begin + place - shift, begin + place + octave
    keep = np.flatnonzero((words[left] == words[right]) & (EXPONENT * (octave + shift) <= n[piece]))
    for k in range(1, min(octave, FIRST_WORDS)):
        keep = keep[place[keep] + octave + k < n[piece[keep]]]
        keep = keep[words[left[keep] + k] == words[right[keep] + k]]
    rows = []
    piece, boundary, period = piece[keep], (place - shift)[keep], (octave + shift)[keep]
    cuts = np.flatnonzero(np.r_[True, (np.diff(piece) != 0) | (np.diff(boundary) != 0), True]) if len(piece) else np.zeros(1, int)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        i, middle = int(piece[a]), int(boundary[a])
        reach = max(int(first[i]), middle - LEFT * octave)
        ends = min(int(n[i]), middle + RIGHT * octave)
        held = words[int(at[i] - first[i]) + reach : int(at[i] - first[i]) + ends]
        rows += [(i, q, s + reach, e + reach) for q, s, e in tile(held, middle - reach, period[a:b].tolist(), octave)]
    return np.array(rows, np.int64).reshape(-1, 4)


def joined(rows: np.ndarray) -> np.ndarray:
    """Fragments that overlap by a period made one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    group = np.cumsum(np.r_[0, (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)])
    reached = np.maximum.accumulate(rows[:, 3] + group * _STRIDE) - group * _STRIDE
    new = np.r_[True, (np.diff(group) != 0) | (rows[1:, 2] + rows[1:, 1] > reached[:-1])]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(rows) - 1]
    return np.column_stack([rows[new][:, :3], reached[last]])


def octaves(n: int) -> Iterator[int]:
    """Smallest periods of the octaves that a document of ``n`` words can have runs in."""
    octave = 1
    while n >= LEAST and EXPONENT * octave <= n:
        yield octave
        octave *= 2


def _altered(batch: pa.RecordBatch, planting: Planting | None) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the batch's texts (key, mark, text) as altered, and the texts' bounds among them."""
    words = Texts.of(batch.column(2)).words
    held = words.hashes
    if planting is not None:
        held = held.copy()
        for i, key in enumerate(batch.column(0).to_pylist()):
            s, e = int(words.bounds[i]), int(words.bounds[i + 1])
            places = planting(key, e - s)
            if places is not None:
                held[s:e] = held[s:e][places]
    return held, words.bounds


def smallest(rows: np.ndarray) -> np.ndarray:
    """Of rows that span the same words of a document, the one of smallest period; by document."""
    rows = rows[np.lexsort((rows[:, 1], rows[:, 3], rows[:, 2], rows[:, 0]))]
    return rows[np.r_[True, (np.diff(rows[:, [0, 2, 3]], axis=0) != 0).any(1)]] if len(rows) else rows


def _found(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Runs of whole documents, rows of (document, period, start, end), by document."""
    n = np.diff(bounds)
    found = [np.zeros((0, 4), np.int64)]
    for octave in octaves(int(n.max(initial=0))):
        which = np.flatnonzero(n >= max(LEAST, EXPONENT * octave))
        none = np.zeros(len(which), np.int64)
        rows = solved(words, octave, bounds[which], none, none, n[which], n[which])
        rows[:, 0] = which[rows[:, 0]]
        found.append(rows)
    rows = joined(np.concatenate(found))
    return smallest(rows[rows[:, 3] - rows[:, 2] >= np.maximum(LEAST, EXPONENT * rows[:, 1])])


def searched(docs: DataFrame, key: str = "doc_id", text: str = "text", planting: Planting | None = planted, long_bytes: int = LONG_BYTES, texts: bool = True) -> DataFrame:
    """Per row: ``key``, mark (tells texts of one id apart), found (fragments of a text that is not long), sha256 of the words where
    there are none, and the text where there are some, where it is long, or always (``texts``)."""
    kind = docs.schema[key].dataType.simpleString()
    read = docs.select(F.col(key).alias(key), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    shape = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            bodies = [x.as_py() or "" for x in batch.column(2)]
            sizes = [len(x.encode("utf-8", "surrogatepass")) for x in bodies]
            is_long = np.array(sizes) > long_bytes
            whole = batch.set_column(2, "text", pa.array(["" if x else y for x, y in zip(is_long, bodies, strict=True)], pa.string()))
            rows = _found(*_altered(whole, planting))
            cuts = np.searchsorted(rows[:, 0], np.arange(batch.num_rows + 1)).tolist()
            found = [[{"period": q, "start": s, "end": e} for _, q, s, e in rows[cuts[i] : cuts[i + 1]].tolist()] for i in range(batch.num_rows)]
            open_ = [bool(x or y) for x, y in zip(is_long, found, strict=True)]
            sha = [None if x else hashlib.sha256(b" ".join(_words(k, t, planting))).hexdigest() for x, k, t in zip(open_, batch.column(0).to_pylist(), bodies, strict=True)]
            kept = [t if x or texts else None for x, t in zip(open_, bodies, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, shape), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                names=[key, "mark", "found", "sha256", "text"],
            )

    return read.mapInArrow(search, f"`{key}` {kind}, mark long, found array<struct<period: long, start: long, end: long>>, sha256 string, text string")


def fragments_of_long(docs: DataFrame, key: str = "doc_id", text: str = "text", planting: Planting | None = planted, long_bytes: int = LONG_BYTES, row_words: int = ROW_WORDS) -> DataFrame:
    """Rows (``key``, mark, period, start, end) of the long documents, whose tiles are dealt over the cluster."""
    kind = docs.schema[key].dataType.simpleString()
    read = docs.where(F.octet_length(text) > long_bytes).select(F.col(key).alias(key), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            words, bounds = _altered(batch, planting)
            for i in range(batch.num_rows):
                held = words[bounds[i] : bounds[i + 1]]
                n = len(held)
                for octave in octaves(n):
                    span = max(octave, row_words // octave * octave)
                    for low in range(0, n - octave, span):
                        first, high = max(0, low - LEFT * octave), min(n, low + span)
                        made = held[first : min(n, high + RIGHT * octave)].tobytes()
                        columns = [pa.array([x], pa.int64()) for x in (n, octave, first, low, high)]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0)[i : i + 1], batch.column(1)[i : i + 1], *columns, pa.array([made], pa.binary())],
                            names=[key, "mark", "n", "octave", "first", "low", "high", "words"],
                        )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, octave, first, low, high = (batch.column(k).to_numpy() for k in range(2, 7))
            for i in range(batch.num_rows):
                words = np.frombuffer(batch.column(7)[i].as_py(), np.uint64)
                one = slice(i, i + 1)
                rows = joined(solved(words, int(octave[i]), np.zeros(1, np.int64), first[one], low[one], high[one], n[one]))
                owner = pa.array(rows[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[one].take(owner), batch.column(1)[one].take(owner), *(pa.array(rows[:, k]) for k in (1, 2, 3))],
                    names=[key, "mark", "period", "start", "end"],
                )

    tiles = read.mapInArrow(explode, f"`{key}` {kind}, mark long, n long, octave long, first long, low long, high long, words binary")
    return tiles.repartition(key, "mark", "octave", "low").mapInArrow(solve, f"`{key}` {kind}, mark long, period long, start long, end long")


def stitched(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Runs (``key``, mark, start, length, period) from fragments."""
    before = Window.partitionBy(key, "mark", "period").orderBy("start", "end")
    upto = before.rowsBetween(Window.unboundedPreceding, -1)
    opened = found.withColumn("new", F.coalesce(F.col("start") + F.col("period") > F.max("end").over(upto), F.lit(True)).cast("int"))
    pieces = opened.withColumn("piece", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    whole = pieces.groupBy(key, "mark", "period", "piece").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    long_enough = whole.where(F.col("length") >= F.greatest(F.lit(LEAST), EXPONENT * F.col("period")))
    return long_enough.groupBy(key, "mark", "start", "length").agg(F.min("period").alias("period"))


def collapsed(docs: DataFrame, key: str = "doc_id", text: str = "text", planting: Planting | None = planted, long_bytes: int = LONG_BYTES, row_words: int = ROW_WORDS, texts: bool = True) -> DataFrame:
    """Per row: ``key``, n_runs, start, length, period and exponent_milli of the longest run, digests of all runs and of the words
    that stay when of every run only the first period is kept, and (``texts``) runs and these words as ``collapsed``.

    Only texts with runs are shuffled.
    """
    ready = stored(searched(docs, key, text, planting, long_bytes, texts), "searched")
    of_short = ready.select(key, "mark", F.inline("found"))
    each = stitched(of_short.unionAll(fragments_of_long(docs, key, text, planting, long_bytes, row_words)), key)
    listed = each.groupBy(F.col(key).alias("_key"), F.col("mark").alias("_mark")).agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))  # fewer than words in the text
    with_runs = ready.where("sha256 is null").hint("merge").join(listed, F.col(key).eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark")), "left")
    none = F.lit(None).cast("array<struct<start: bigint, period: bigint, length: bigint>>").alias("runs")
    both = with_runs.select(key, "text", "runs", "sha256").unionAll(ready.where("sha256 is not null").select(key, "text", none, "sha256"))
    names = [key, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 3

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            rows = []
            for k, value, found, sha in zip(*(batch.column(i) for i in range(4)), strict=True):
                rows.append(_answer(k.as_py(), value.as_py(), found.as_py() or [], sha.as_py(), planting))
            columns = [pa.array([x[i] for x in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, batch.column(2)], names=[*names, "collapsed", "runs"])

    kind = docs.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string"
    answered = both.mapInArrow(answer, f"{shape}, runs array<struct<start: long, period: long, length: long>>")
    return answered if texts else answered.select(*names)


def _words(key: object, text: str, planting: Planting | None) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes part at space and tab to carriage return
    places = planting(key, len(words)) if planting is not None else None
    return words if places is None else [words[i] for i in places.tolist()]


def _answer(key: object, text: str | None, found: list[dict], sha: str | None, planting: Planting | None) -> tuple:
    best, left = (None,) * 4, None
    if text is not None:
        words = _words(key, text, planting)
        stay = np.ones(len(words), bool)
        for run in found:
            stay[run["start"] + run["period"] : run["start"] + run["length"]] = False
        left = b" ".join([words[i] for i in np.flatnonzero(stay).tolist()])
    if found:
        top = min(found, key=lambda x: (-x["length"], x["start"], x["period"]))
        best = (top["start"], top["length"], top["period"], 1000 * top["length"] // top["period"])
    said = "".join(f"{x['start']},{x['length']},{x['period']}\n" for x in found)
    return (len(found), *best, hashlib.sha256(said.encode()).hexdigest(), sha or hashlib.sha256(left).hexdigest(), left.decode("utf-8", "surrogatepass") if left is not None else None)
