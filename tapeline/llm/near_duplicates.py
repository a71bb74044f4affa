"""Near duplicates by a grouped prefix join over word shingles.

Two documents link when their sets of shingles of WIDTH words have a Jaccard similarity of SHARE hundredths or more. The
steps, each exact:

1. Sieve. Of any two linked documents, the prefixes in hash order, longer by a tenth of the set than a plain prefix, share
   more than that tenth. A document too few of whose prefix shingles occur in any other prefix has no partner.
2. Classes. Documents with equal sets are one class, of which the smallest id goes on.
3. Order. How many classes hold each shingle is counted; sets are put in order, rare shingles first. A class with too few
   shingles that any other class holds has no partner. What is left are the nodes.
4. Groups. Nodes with the same prefix and size are one group. Only groups are listed under the shingles of a prefix.
5. Clusters of groups connected by such lists are compared in tasks of bounded size. Within one, pairs of groups are found
   by their lists and filtered by size; members are then expanded and verified on whole sets. A cluster of more than
   TASK_SHINGLES is cut into slots, and each pair of slots is a task, so that no task grows with a cluster.

Steps 1 to 3 are questions over blocks of documents (see ``blocks``); a frequent shingle weighs one entry per block. Shingles
are 64-bit hashes; for counting, SIEVE bytes of them do: shingles that look alike only seem more frequent to all.

Defined cases: a null or empty text, or one without words, has no shingles and links with nothing; with fewer words than
WIDTH the whole sequence is the one shingle. Rows that repeat are of one component. A null id links with nothing and has no
component. An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm import blocks as b
from tapeline.llm.components import components
from tapeline.llm.tables import stored
from tapeline.llm.texts import Texts, mixed

WIDTH = 5
SHARE = 80
SIEVE = 6
#: Bytes of the keys of each question.
KEPT = {1: (SIEVE,), 2: (8, 8), 3: (SIEVE,)}
#: Shingles that a task compares, about.
TASK_SHINGLES = 1_000_000


def shingles(texts: Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, one text after the other; and the bounds of the texts among them."""
    words = texts.words
    values, at = words.windows(width)
    owner = words.owner[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        each = [words.hashes[words.bounds[i] : words.bounds[i + 1]].tobytes() for i in short]
        values = np.concatenate([values, np.array([xxhash.xxh3_64_intdigest(x) for x in each], np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def least_common(n: np.ndarray, share: int = SHARE) -> np.ndarray:
    """Shingles a set of ``n`` shares at least with any linked one."""
    return -(-share * n // 100)


def _spare(n: np.ndarray) -> np.ndarray:
    return 1 + n // 10


class _Block:
    """A block with what is known after each question."""

    def __init__(self, table: pa.Table, width: int, share: int):
        self.number = table["block"][0].as_py() if len(table) else -1
        self.keys, bodies = b.bodies(table)
        self.known = ~np.array(self.keys.is_null())
        self.ids = self.keys.fill_null(0).to_numpy()
        self.values, self.bounds = shingles(Texts.of(bodies, lower=True), width)
        self.n = np.diff(self.bounds)
        self.need = least_common(self.n, share)
        self.owner = np.repeat(np.arange(len(self.n)), self.n)

    def _of(self, docs: np.ndarray) -> np.ndarray:
        """Entries of the documents marked in ``docs``."""
        return np.flatnonzero(docs[self.owner])

    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Question 1: shingles of the longer prefixes, spread over all key ranges: in hash order they are low."""
        rank = np.arange(len(self.values)) - self.bounds[self.owner]
        length = self.n - self.need + _spare(self.n)
        self.front = np.flatnonzero((rank < length[self.owner]) & self.known[self.owner])
        found, counts, self.front_place = b.distinct(b.top(mixed(self.values[self.front]), SIEVE), self.owner[self.front])
        return found, counts

    def sets(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Question 2: hashes of the sets that pass the sieve, with their smallest ids."""
        self.prefixes()
        common = (b.answers(replies, 1) > 1)[self.front_place]
        shared = np.bincount(self.owner[self.front[common]], minlength=len(self.n))
        self.passed = np.flatnonzero((self.n > 0) & self.known & (shared >= _spare(self.n)))
        marks = [xxhash.xxh3_128_digest(self.values[self.bounds[i] : self.bounds[i + 1]]) for i in self.passed]
        keys = np.frombuffer(b"".join(marks), np.uint64).reshape(-1, 2)
        order = np.lexsort((self.ids[self.passed], keys[:, 1], keys[:, 0]))
        new = np.r_[True, (keys[order][1:] != keys[order][:-1]).any(1)] if len(keys) else np.zeros(0, bool)
        self.set_place = np.zeros(len(keys), np.int64)
        self.set_place[order] = np.cumsum(new) - 1
        self.first = self.passed[order[new]]  # of each set in the block, the row of smallest id
        return keys[order[new]], self.ids[self.first]

    def classes(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Question 3: all shingles of the classes' first documents."""
        self.sets(replies)
        self.class_of = b.answers(replies, 2, "i8")
        chosen = np.zeros(len(self.n), bool)
        chosen[self.first[self.class_of == self.ids[self.first]]] = True
        self.entries = self._of(chosen)
        found, counts, self.entry_place = b.distinct(b.top(self.values[self.entries], SIEVE), self.owner[self.entries])
        return found, counts

    def nodes(self, replies: pa.Table, key: str) -> pa.Table:
        """Rows of the result of ``prepared``."""
        self.classes(replies)
        counts = b.answers(replies, 3)[self.entry_place]
        owner = self.owner[self.entries]
        order = np.lexsort((self.values[self.entries], counts, owner))
        values, counts, owner = self.values[self.entries][order], counts[order], owner[order]
        common = np.bincount(owner[counts > 1], minlength=len(self.n))
        stay = np.unique(owner)
        stay = stay[common[stay] >= self.need[stay]]
        classes = self.ids.copy()
        classes[self.passed] = self.class_of[self.set_place]
        ordered, listed = [None] * len(self.n), [None] * len(self.n)
        bounds = np.searchsorted(owner, np.arange(len(self.n) + 1))
        for i in stay.tolist():
            s, e = bounds[i], bounds[i + 1]
            front = s + int(self.n[i] - self.need[i]) + 1
            ordered[i] = values[s:e].tobytes()
            listed[i] = values[s:front][counts[s:front] > 1].view(np.int64)
        marks = [None if x is None else xxhash.xxh3_64_intdigest(x[: 8 * (int(self.n[i] - self.need[i]) + 1)]) - (1 << 63) for i, x in enumerate(ordered)]
        return pa.table(
            {
                key: self.keys,
                "n_shingles": pa.array(self.n, pa.int64()),
                "class_id": pa.array(classes, pa.int64(), mask=~self.known),
                "shingles": pa.array(ordered, pa.binary()),
                "front": pa.array(marks, pa.int64()),
                "listed": pa.array(listed, pa.list_(pa.int64())),
            }
        )


def _least_ids(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    order = np.lexsort((ids, keys[:, 1], keys[:, 0]))
    if not len(order):
        return ids
    new = np.r_[True, (keys[order][1:] != keys[order][:-1]).any(1)]
    result = np.empty(len(ids), np.int64)
    result[order] = ids[order][new][np.cumsum(new) - 1]
    return result


def prepared(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, share: int = SHARE, block_bytes: int = b.BLOCK_BYTES) -> DataFrame:
    """Steps 1 to 3, stored. Per row: ``key``, n_shingles, class_id, and for nodes shingles (rare first), front (a hash of
    the prefix) and listed (those of the prefix that other classes hold)."""
    dealt, n = b.dealt(docs, key, text, block_bytes)
    by_block = dealt.groupBy("block")

    def first(table: pa.Table) -> pa.Table:
        block = _Block(table, width, share)
        return b.asked(block.number, n, *block.prefixes(), KEPT[1])

    def later(method: str, number: int):
        def ask(table: pa.Table, replies: pa.Table) -> pa.Table:
            block = _Block(table, width, share)
            return b.asked(block.number, n, *getattr(block, method)(replies), KEPT[number])

        return ask

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _Block(table, width, share).nodes(replies, key)

    replies = b.answered(by_block.applyInArrow(first, b.ASK), 1, b.total_counts, KEPT[1])
    asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(later("sets", 2), b.ASK)
    replies = replies.unionAll(b.answered(asked, 2, _least_ids, KEPT[2], kind="i8"))
    asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(later("classes", 3), b.ASK)
    replies = replies.unionAll(b.answered(asked, 3, b.total_counts, KEPT[3]))
    shape = f"`{key}` long, n_shingles long, class_id long, shingles binary, front long, listed array<long>"
    return stored(by_block.cogroup(replies.groupBy("block")).applyInArrow(finish, shape), "shingles")


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


def linked(ids: np.ndarray, sets: list[bytes], slots: np.ndarray, crossing: bool, share: int = SHARE) -> np.ndarray:
    """For each node the smallest id it is connected with. ``sets``: shingles, rare first. ``crossing``: only pairs of
    different slots are compared."""
    order = np.argsort(ids, kind="stable")
    ids, slots, sets = ids[order], slots[order], [sets[i] for i in order]
    n = np.array([len(x) // 8 for x in sets])
    fronts = n - least_common(n, share) + 1
    ends = np.cumsum(n)
    starts = ends - n
    _, tokens = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
    groups: dict[tuple, list[int]] = {}
    for i in range(len(ids)):
        groups.setdefault((n[i], sets[i][: 8 * fronts[i]]), []).append(i)
    members = list(groups.values())
    head = np.array([x[0] for x in members])
    # the lists: groups under each shingle of their prefixes
    entries = np.concatenate([tokens[starts[i] : starts[i] + fronts[i]] for i in head])
    under = np.repeat(np.arange(len(head)), fronts[head])
    at = np.argsort(entries, kind="stable")
    listed, lists = under[at], np.searchsorted(entries[at], np.arange(tokens.max() + 2))
    union, held = _Union(len(ids)), np.zeros(tokens.max() + 1, np.int64)
    for g, own in enumerate(members):
        front = tokens[starts[own[0]] : starts[own[0]] + fronts[own[0]]]
        near = np.unique(np.concatenate([listed[lists[t] : lists[t + 1]] for t in front]))
        near = near[near >= g]
        size, mine = n[head[near]], n[own[0]]
        near = near[(100 * size >= share * mine) & (100 * mine >= share * size)]
        others = np.array([j for h in near for j in members[h]])
        for i in own:
            roots = np.array([union.find(j) for j in others])
            left = others[(roots != union.find(i)) & ((slots[others] != slots[i]) | (not crossing))]
            if not len(left):
                continue
            held[tokens[starts[i] : ends[i]]] = 1
            which = np.repeat(starts[left] - (np.cumsum(n[left]) - n[left]), n[left]) + np.arange(n[left].sum())
            common = np.add.reduceat(held[tokens[which]], np.cumsum(n[left]) - n[left])
            held[tokens[starts[i] : ends[i]]] = 0
            for j in left[100 * common >= share * (n[i] + n[left] - common)]:
                union.join(i, int(j))
    roots = np.array([union.find(i) for i in range(len(ids))])
    result = np.empty(len(ids), np.int64)
    result[order] = ids[roots]
    return result


def joined(nodes: DataFrame, share: int = SHARE, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """Steps 4 and 5: rows (node, component) of the nodes (node, n, shingles, front, listed) that have a partner or might."""
    grouped = nodes.groupBy("front", "n").agg(F.min("node").alias("group"), F.count("*").alias("members"), F.sum("n").alias("weight"))
    lists = nodes.join(grouped.select(F.col("group").alias("node")), "node", "left_semi").select("front", "n", "listed")
    lists = lists.join(grouped.select("front", "n", "group"), ["front", "n"]).select("group", F.explode("listed").alias("shingle"))
    lists = stored(lists.distinct(), "lists")
    lowest = lists.groupBy("shingle").agg(F.min("group").alias("low"), F.count("*").alias("groups")).where("groups > 1")
    edges = lists.join(lowest, "shingle").select(F.col("group").alias("a"), F.col("low").alias("b")).distinct()
    crowds = grouped.where("members > 1").select(F.col("group").alias("a"), F.col("group").alias("b"))
    cluster = components(edges.unionAll(crowds)).select(F.col("node").alias("group"), F.col("component").alias("cluster"))
    cluster = grouped.join(cluster, "group")
    sizes = cluster.groupBy("cluster").agg(F.ceil(F.sum("weight") / task_shingles).cast("int").alias("slots"))
    placed = stored(cluster.join(sizes, "cluster").select("front", "n", "cluster", "slots"), "clusters")
    slot = F.pmod(F.xxhash64("node"), F.col("slots")).cast("int")
    dealt = nodes.join(placed, ["front", "n"]).select("node", "shingles", "cluster", "slots", slot.alias("slot"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    dealt = dealt.select("node", "shingles", "cluster", "slots", "slot", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"))

    def compare(task: pa.Table) -> pa.Table:
        ids, slots = task["node"].to_numpy(), task["slot"].to_numpy()
        low = linked(ids, task["shingles"].to_pylist(), slots, task["i"][0] != task["j"][0], share)
        return pa.table({"a": pa.array(ids, pa.int64()), "b": pa.array(low, pa.int64()), "slots": task["slots"]})

    found = stored(dealt.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long, slots int"), "links")
    whole = found.where("slots = 1").select(F.col("a").alias("node"), F.col("b").alias("component")).distinct()
    cut = found.where("slots > 1").select("a", "b")
    return whole if cut.isEmpty() else whole.unionAll(components(cut))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, share: int = SHARE, block_bytes: int = b.BLOCK_BYTES, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """Per row: ``key``, n_shingles, component_id (the smallest id that links reach)."""
    ready = prepared(docs, key, text, width, share, block_bytes)
    nodes = ready.where("shingles is not null").select(F.col(key).alias("node"), F.col("n_shingles").alias("n"), "shingles", "front", "listed")
    found = stored(joined(nodes, share, task_shingles), "components")
    found = found.groupBy(F.col("node").alias("class_id")).agg(F.min("component").alias("component"))
    result = ready.select(key, "n_shingles", "class_id").join(found, "class_id", "left")
    kind = docs.schema[key].dataType
    return result.select(F.col(key).cast(kind).alias(key), "n_shingles", F.coalesce("component", "class_id").cast(kind).alias("component_id"))


def oracle(width: int = WIDTH, share: int = SHARE) -> str:
    """The same result over ``documents`` in SQL, all pairs with a common shingle counted; for small tables."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""
    with recursive split as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') as words
      from documents
    ), sets as (
      select distinct doc_id, unnest(case when len(words) >= {width}
        then list_transform(range(1, len(words) - {width - 2}), lambda i: array_to_string(words[i:i + {width - 1}], ' '))
        when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as shingle
      from split
    ), sizes as (
      select doc_id, count(shingle) as n from documents left join sets using (doc_id) group by doc_id
    ), common as (
      select a.doc_id as x, b.doc_id as y, count(*) as n
      from sets a join sets b using (shingle) where a.doc_id <> b.doc_id group by all
    ), links as (
      select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y
      where 100 * common.n >= {share} * (a.n + b.n - common.n)
    ), reached as (
      select doc_id, doc_id as other from documents
      union select reached.doc_id, y from reached join links on x = other
    )
    select doc_id, any_value(n) as n_shingles, min(other) as component_id
    from reached join sizes using (doc_id) group by doc_id
    """
