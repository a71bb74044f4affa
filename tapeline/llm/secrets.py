"""Secrets in texts: rules find the plain ones, a character network judges every other candidate in its context.

Rules give the base findings, which stay. A candidate is a run of the alphabet of keys and encodings, of at least LONG
characters, or of at least SHORT that mix letters with digits or cases within. Runs that a base finding covers are none, nor is
the name before a value that an assignment names; a run that goes on beyond another finding is one, and when it is taken
its span stands beside the finding's. A convolutional network in numpy reads the run with its surroundings as characters and
gives a score; a run longer than VALUE is read whole, in windows that overlap by half, and has the largest of their scores.
It is trained on all labelled findings: values found by the rules are positive, candidates no rule names are negative, though
secrets may be among them; runs beyond a finding have no label. To these come MADE findings of each shape in ``made``, made by
rule: keys of usual issuers and alphabets, and harmless dates, versions, paths and names, which a corpus may lack. Every finding of
either label is shown
twice, with its surroundings and with both sides blanked, and scores the larger of the two: no candidate has the word that
gave a positive away, so its surroundings may add to what its value looks like but not take from it. Secrets among the
negatives would be learnt by heart: two networks, each from half of the findings, judge the other half, and negatives that
one of them takes for a secret are not trained on. Scores are calibrated
on findings held back from training. The threshold keeps the demanded recall on the blanked positives among these, however
low that score is: it lies half-way between the score that does and the next one of a negative.

Training is Spark's: the different views are dealt by a hash into shards of about SHARD, whose number grows with the corpus. A
pass is one job, in which a copy of the network goes over each shard, and over the made views beside it; the next pass starts from
the mean of the copies. Logits are rounded, so that their counts by value are all that calibration and threshold need of the
findings held back. Means and counts are sums of whole numbers, so that they do not depend on the order of the tasks.

Defined cases: a null or empty text has no findings. Texts that repeat are each answered. Without findings of both labels
there is no network and only base findings are given. An empty table gives an empty result. Other columns of the input are
not looked at.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.tables import stored

KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6

#: Candidates: runs of at least LONG characters, and mixed ones of at least SHORT.
LONG, SHORT = 16, 12
CANDIDATES = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % SHORT)
#: Characters of the value and of its surroundings on either side that the network sees.
VALUE, AROUND = 48, 16
WIDTH = VALUE + 2 * AROUND
#: Findings made by rule of each shape of keys and of harmless runs.
MADE = 60
#: About so many views make a shard, over which one copy of the network goes.
SHARD = 6_000
FILTERS, SPAN = 24, 5
EPOCHS, BATCH, RATE, SEED = 12, 64, 0.01, 11
RECALL = 0.95
#: Logits are rounded to one part in FINE, up to FAR on both sides of zero.
FINE, FAR = 256, 32
#: Means of networks are taken of whole numbers of so small a part.
_PART = 2.0**40
#: Steps of a network are kept in this unit, so that they fit beside its weights.
_STEPS = 4096

#: Character classes of the network: 0 nothing, then one for each printable ASCII character, the last for all others.
N_CHARS = 97


def base_findings(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of the rules, by start, then kind as listed. Offsets in code points."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def is_candidate(run: str) -> bool:
    """Long enough, or mixed: letters and digits, or a capital after the first character beside small letters."""
    if len(run) >= LONG:
        return True
    letters = any(map(str.isalpha, run))
    return letters and (any(map(str.isdigit, run)) or (run[1:] != run[1:].lower() and run != run.upper()))


def open_runs(text: str, base: list[tuple[str, int, int, int]]) -> list[tuple[int, int, bool]]:
    """Candidates as (start, end, whether the run goes on beyond a base finding that it touches)."""
    runs = []
    at = 0  # base findings that end before the run are passed for good
    ends = np.maximum.accumulate([x[2] for x in base]) if base else []
    for m in CANDIDATES.finditer(text):
        s, e = m.span()
        if not is_candidate(m.group()):
            continue
        while at < len(base) and ends[at] <= s:
            at += 1
        k, touches, answered = at, False, False
        while k < len(base) and base[k][1] < e:
            kind, start, end, _ = base[k]
            if end > s:
                touches = True
                # a value ends with its run, and what stands before it is its name
                answered = answered or kind == "assign" or (start <= s and end >= e)
            k += 1
        if not answered:
            runs.append((s, e, touches))
    return runs


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def _codes(text: str) -> bytes:
    return bytes(min(max(ord(c) - 31, 0), N_CHARS - 1) if c >= " " else N_CHARS - 1 for c in text)


def window(text: str, start: int, end: int, mask: int = 0) -> bytes:
    """The value from ``start`` to ``end``, at most VALUE characters, with its surroundings, one class per character; ``mask``
    characters before the value are blanked."""
    before = text[max(0, start - AROUND) : start]
    if mask:
        before = before[: max(0, len(before) - mask)]
    value, after = text[start:end], text[end : end + AROUND]
    left = _codes(before).ljust(AROUND, b"\0") if mask else _codes(before).rjust(AROUND, b"\0")
    return left + _codes(value).ljust(VALUE, b"\0") + _codes(after).ljust(AROUND, b"\0")


def windows(text: str, start: int, end: int) -> list[bytes]:
    """Windows that together show the whole value: one, or several that overlap by half, the last at the value's end."""
    last = max(start, end - VALUE)
    return [window(text, s, min(s + VALUE, end)) for s in [*range(start, last, VALUE // 2), last]]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, base (findings of the rules) and open (candidates), arrays of kind, start, end, views and beyond.

    ``views`` is what the network sees. A rule's value is a labelled positive, a candidate a negative unless it goes on
    ``beyond`` a finding.
    """
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("views", pa.list_(pa.binary())), ("beyond", pa.bool_())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, opens = [], []
            for value in batch.column(1):
                body = value.as_py() or ""
                base = base_findings(body)
                bases.append([{"kind": k, "start": s, "end": e, "views": windows(body, v, e), "beyond": False} for k, s, e, v in base])
                opens.append([{"kind": KINDS[3], "start": s, "end": e, "views": windows(body, s, e), "beyond": x} for s, e, x in open_runs(body, base)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, span), pa.array(opens, span)], names=[key, "base", "open"])

    kind = docs.schema[key].dataType.simpleString()
    shape = "array<struct<kind: string, start: int, end: int, views: array<binary>, beyond: boolean>>"
    return docs.select(key, text).mapInArrow(find, f"`{key}` {kind}, base {shape}, open {shape}")


def made(n: int = MADE, seed: int = 5) -> tuple[list[bytes], list[bytes]]:
    """Views of ``n`` keys of each shape, and of as many harmless runs of each shape."""
    random = np.random.default_rng(seed)
    upper, lower, digits = string.ascii_uppercase, string.ascii_lowercase, string.digits
    draw = lambda letters, k: "".join(letters[i] for i in random.integers(0, len(letters), k))
    number = lambda low, high: int(random.integers(low, high))
    name = lambda k: "".join(draw("bcdfghklmnprstvw", 1) + draw("aeiou", 1) + draw("nrst"[: number(1, 5)], number(0, 2)) for _ in range(k))
    word = lambda: name(number(1, 5))
    mixed = upper + lower + digits
    keys = [
        lambda: "sk_live_" + draw(mixed, 24),
        lambda: "ghp_" + draw(mixed, 36),
        lambda: f"xoxb-{draw(digits, 12)}-{draw(mixed, 24)}",
        lambda: draw(mixed + "+/", 40),
        lambda: draw(mixed + "+/", 62) + "==",
        lambda: ".".join(("eyJ" + draw(mixed + "_-", number(17, 60)), "eyJ" + draw(mixed + "_-", number(20, 200)), draw(mixed + "_-", 43))),
        lambda: draw(digits + "ABCDEF", number(24, 65)),
        lambda: draw(upper + lower, number(20, 41)),
        lambda: draw(mixed, number(12, 20)),
        lambda: draw(mixed, number(20, 65)),
        lambda: draw(lower + digits, number(20, 41)),
        lambda: f"{name(number(1, 3))}_" + draw(digits + "abcdef", number(24, 41)),
        lambda: "shpat_" + draw(digits + "abcdef", 32),
    ]
    day = lambda: f"{number(1970, 2040)}-{number(1, 13):02}-{number(1, 29):02}"
    clock = lambda mark: mark.join(f"{number(0, 60):02}" for _ in range(3))
    harmless = [
        lambda: f"{day()}T{clock('.')}Z",
        lambda: f"{day()}_{clock('-')}." + draw(digits, number(3, 7)),
        lambda: f"{word()}-{number(0, 30)}.{number(0, 30)}.{number(0, 300)}-rc{number(0, 9)}.{word()}",
        lambda: f"v{number(0, 30)}.{number(0, 30)}.{number(0, 300)}-build.{number(1, 90000)}",
        lambda: "/" + "/".join(word() for _ in range(number(3, 8))) + number(0, 2) * f"/{word()}{number(0, 100)}.py",
        lambda: f"//www.{name(number(2, 5))}.{draw(lower, 3)}/{word()}/{number(1, 9999)}/{word()}.html",
        lambda: f"{word()}.{word()}{number(0, 100)}.mail{number(0, 99)}.{name(3)}.com",
        lambda: "-".join(word() for _ in range(number(4, 8))),
        lambda: "_".join(word() for _ in range(number(4, 8))) + f"_{number(0, 100)}",
        lambda: "".join(word().capitalize() for _ in range(number(4, 7))),
        lambda: name(number(7, 12)) + "." * number(0, 2),
        lambda: name(number(7, 12)).capitalize(),
        lambda: draw(digits, number(16, 21)),
        lambda: draw("=-_.", 1) * number(16, 60),
    ]

    def seen(shapes: list) -> list[bytes]:
        views = []
        for _ in range(n):
            for shape in shapes:
                before, run = f"{word()} {word()} ", shape()
                views += windows(f"{before}{run} {word()}", len(before), len(before) + len(run))
        return views

    return seen(keys), seen(harmless)


@dataclass
class Network:
    """Embedding and convolution in one table, largest value over places, logistic output; ``a`` and ``b`` calibrate.
    ``recall`` and ``precision`` are those at the threshold on held-back findings, the positives without surroundings and
    the ``doubtful`` negatives, which were left out, not counted. Findings made by rule count in every shard."""

    table: np.ndarray  # SPAN, N_CHARS, FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    a: float = 1.0
    b: float = 0.0
    threshold: float = 1.0
    recall: float = 0.0
    precision: float = 0.0
    doubtful: int = 0

    def convolved(self, views: np.ndarray) -> np.ndarray:
        places = WIDTH - SPAN + 1
        return sum(self.table[k][views[:, k : k + places]] for k in range(SPAN)) + self.bias

    def logits(self, views: np.ndarray) -> np.ndarray:
        """Rounded, so that few different values stand for any number of views."""
        parts = [np.maximum(self.convolved(views[i : i + 512]), 0).max(1) @ self.out + self.out_bias for i in range(0, len(views), 512)]
        return np.clip(np.rint(np.concatenate(parts) * FINE) / FINE, -FAR, FAR) if parts else np.zeros(0)

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * logits + self.b, -30, 30)))

    def scores(self, views: np.ndarray) -> np.ndarray:
        """Of each view as it is and without surroundings, the larger score."""
        return self.calibrated(np.maximum(self.logits(views), self.logits(blanked(views))))


def blanked(views: np.ndarray) -> np.ndarray:
    """The views without their surroundings."""
    return np.pad(views[:, AROUND : AROUND + VALUE], ((0, 0), (AROUND, AROUND)))


def as_views(views: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(views), np.uint8).reshape(-1, WIDTH)


@dataclass
class Shard:
    """Views with their labels, of which 2 is a negative left out as doubtful; those after the first ``n`` are made ones."""

    number: int
    views: np.ndarray
    labels: np.ndarray
    n: int

    def folds(self, seed: int) -> np.ndarray:
        return np.random.default_rng([seed, self.number]).permutation(len(self.views)) % 10

    def chosen(self, half: int | None, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the findings of a half, or of all, to train on, and of a fifth of them that is held back."""
        fold = self.folds(seed)
        mine = (self.labels < 2) & (True if half is None else fold % 2 == half)
        return np.flatnonzero(mine & (fold > 1)), np.flatnonzero(mine & (fold <= 1))


#: What is summed over shards: whole numbers, which add up to the same in any order.
Sums = Callable[[Shard], np.ndarray]


@dataclass
class Held:
    """A single shard in memory."""

    shard: Shard
    count: int = 1

    def sums(self, f: Sums) -> np.ndarray:
        return f(self.shard)

    def labelled(self, f: Sums) -> Held:
        return Held(replace(self.shard, labels=f(self.shard)))


@dataclass
class Dealt:
    """Shards as rows (shard, views, labels), to each of which the ``made`` views and labels are added."""

    rows: DataFrame
    count: int
    made: tuple[np.ndarray, np.ndarray]

    def _shards(self) -> Callable[[pa.RecordBatch], Iterator[Shard]]:
        made_views, made_labels = self.made

        def read(batch: pa.RecordBatch) -> Iterator[Shard]:
            for number, views, labels in zip(*(batch.column(k) for k in range(3)), strict=True):
                views, labels = as_views([views.as_py()]), np.frombuffer(labels.as_py(), np.uint8)
                yield Shard(number.as_py(), np.concatenate([views, made_views]), np.concatenate([labels, made_labels]), len(views))

        return read

    def sums(self, f: Sums) -> np.ndarray:
        """One row of sums per task comes to the driver."""
        read = self._shards()

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for shard in read(batch):
                    part = f(shard)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        return sum(np.frombuffer(bytes(row["sums"]), np.int64) for row in self.rows.mapInArrow(add, "sums binary").collect())

    def labelled(self, f: Sums) -> Dealt:
        """The same shards with labels that ``f`` gives."""
        read = self._shards()

        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                labels = [f(shard)[: shard.n].astype(np.uint8).tobytes() for shard in read(batch)]
                yield batch.set_column(2, "labels", pa.array(labels, pa.binary()))

        return replace(self, rows=stored(self.rows.mapInArrow(label, "shard long, views binary, labels binary"), "labelled"))


_AT = np.cumsum([SPAN * N_CHARS * FILTERS, FILTERS, FILTERS, 1])


def _network(weights: np.ndarray) -> Network:
    """A network whose arrays are parts of ``weights``."""
    table, bias, out, out_bias = np.split(weights, _AT[:-1])
    return Network(table.reshape(SPAN, N_CHARS, FILTERS), bias, out, float(out_bias[0]))


def _passed(state: np.ndarray, views: np.ndarray, labels: np.ndarray, share: float, random: np.random.Generator) -> np.ndarray:
    """The state after one pass over the views: weights, their two running means (of the second the root), and steps."""
    state = state.copy()
    weights, mean, spread = state[:-1].reshape(3, -1)
    spread **= 2
    step = int(round(state[-1] * _STEPS))
    net = _network(weights)
    order = random.permutation(len(views))
    for at in range(0, len(order), BATCH):
        step += 1
        x, y = views[order[at : at + BATCH]], labels[order[at : at + BATCH]]
        held_in = net.convolved(x)
        place = held_in.argmax(1)  # example, filter
        top = np.maximum(np.take_along_axis(held_in, place[:, None], 1)[:, 0], 0)
        guess = 1 / (1 + np.exp(-np.clip(top @ net.out + net.out_bias, -30, 30)))
        weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
        wrong = weight * (guess - y) / len(y)
        back = wrong[:, None] * net.out * (top > 0)
        slopes = np.zeros_like(weights)
        table, bias, out, _ = np.split(slopes, _AT[:-1])
        table = table.reshape(net.table.shape)
        filters = np.broadcast_to(np.arange(FILTERS), place.shape)
        for k in range(SPAN):
            np.add.at(table[k], (np.take_along_axis(x, place + k, 1), filters), back)
        table += 1e-4 * net.table
        bias += back.sum(0)
        out += top.T @ wrong + 1e-3 * net.out
        net.out_bias -= RATE * wrong.sum()
        mean += 0.1 * (slopes - mean)
        spread += 0.001 * (slopes**2 - spread)
        weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        weights[-1] = net.out_bias
    np.sqrt(spread, out=spread)
    state[-1] = step / _STEPS
    return state


def _trained(shards: Held | Dealt, seed: int, halves: tuple[int | None, ...]) -> list[Network | None]:
    """A network from each half of the labelled views, or from all of them (None); a fifth of them calibrates it and sets its
    threshold. None without both labels."""

    def counts(shard: Shard) -> np.ndarray:
        return np.concatenate([np.bincount(shard.labels[x], minlength=2) for half in halves for x in shard.chosen(half, seed)])

    seen = shards.sums(counts).reshape(len(halves), 2, 2)  # half, held back, label
    plans = []
    for half, (used, held) in zip(halves, seen, strict=True):
        if ((used + held) > 0).all():
            all_used, all_held = not (used > 0).all(), not held[1]  # too few findings to hold some back
            share = (used + held * all_used)[1] / (used + held * all_used).sum()
            plans.append((half, all_used, all_held, float(share)))

    def shown(shard: Shard, half: int | None, held_too: bool, held: bool) -> np.ndarray:
        parts = shard.chosen(half, seed)
        return np.sort(np.concatenate(parts)) if held_too else parts[held]

    random = np.random.default_rng(seed)
    first = np.concatenate([random.normal(0, 0.1, _AT[0]), np.zeros(FILTERS), random.normal(0, 0.3, FILTERS), [0.0]])
    states = [np.concatenate([first, np.zeros(2 * len(first) + 1)]) for _ in plans]
    passes = EPOCHS if shards.count == 1 else 1  # nothing to take the mean of
    for epoch in range(0, EPOCHS if plans else 0, passes):

        def copies(shard: Shard, epoch: int = epoch, states: list[np.ndarray] = states) -> np.ndarray:
            ends = []
            for (half, all_used, _, share), state in zip(plans, states, strict=True):
                places = shown(shard, half, all_used, False)
                views, labels = shard.views[places], shard.labels[places]
                views, labels = np.concatenate([views, blanked(views)]), np.concatenate([labels, labels])
                for k in range(epoch, epoch + passes):
                    state = _passed(state, views, labels, share, np.random.default_rng([seed, shard.number, k]))
                ends.append(np.rint(state * _PART).astype(np.int64))
            return np.concatenate(ends)

        states = list(shards.sums(copies).reshape(len(plans), -1) / (_PART * shards.count))
    networks = [_network(state[: _AT[-1]].copy()) for state in states]

    def logits(shard: Shard) -> np.ndarray:
        found = []
        for (half, _, all_held, _), net in zip(plans, networks, strict=True):
            places = shown(shard, half, all_held, True)
            labels = shard.labels[places]
            plain, bare = (np.rint((net.logits(x) + FAR) * FINE).astype(int) for x in (shard.views[places], blanked(shard.views[places])))
            both = [np.concatenate([plain[labels == k], bare[labels == k]]) for k in (0, 1)]
            found += [np.bincount(x, minlength=2 * FAR * FINE + 1) for x in (*both, bare[labels == 1], np.maximum(plain, bare)[labels == 0])]
        return np.concatenate(found)

    if plans:
        for net, counted in zip(networks, shards.sums(logits).reshape(len(plans), 4, -1), strict=True):
            _calibrate(net, *counted)
    made = iter(networks)
    return [next(made) if ((used + held) > 0).all() else None for used, held in seen]


def _calibrate(net: Network, negative: np.ndarray, positive: np.ndarray, kept: np.ndarray, others: np.ndarray) -> None:
    """Curve and threshold from how often each logit has been held back: of both labels with and without surroundings, of positives
    without them, and of negatives the larger of the two."""
    values = np.arange(-FAR * FINE, FAR * FINE + 1) / FINE
    total = (negative + positive).sum()
    for _ in range(500):  # a logistic curve through the held-back logits
        p = net.calibrated(values)
        wrong = (negative + positive) * p - positive
        net.a = max(net.a - 0.05 * ((wrong * values).sum() / total + 1e-2 * (net.a - 1)), 1e-3)  # a larger logit never scores less
        net.b -= 0.05 * wrong.sum() / total
    score = net.calibrated(values)
    least = score[np.searchsorted(np.cumsum(kept), int(kept.sum() * (1 - RECALL)), side="right")]
    net.threshold = float(least + score[(others > 0) & (score < least)].max(initial=0.0)) / 2
    hits = kept[score >= net.threshold].sum()
    net.recall, net.precision = float(hits / kept.sum()), float(hits / (hits + others[score >= net.threshold].sum()))


def _learnt(shards: Held | Dealt, seed: int) -> Network | None:
    """A network from all labelled views, without the negatives that look like secrets, unless they are made ones. None without
    both labels."""
    judges = _trained(shards, seed, (0, 1))

    def labels(shard: Shard) -> np.ndarray:
        given = shard.labels.copy()
        for half, net in enumerate(judges):
            if net is not None:
                others = np.flatnonzero((shard.labels[: shard.n] == 0) & (shard.folds(seed)[: shard.n] % 2 != half))
                given[others[net.scores(shard.views[others]) >= net.threshold]] = 2
        return given

    judged = shards.labelled(labels) if any(judges) else shards
    negative, doubtful = judged.sums(lambda shard: np.array([(shard.labels == 0).sum(), (shard.labels == 2).sum()]))
    net = _trained(judged if negative else shards, seed, (None,))[0]
    if net is not None and negative:
        net.doubtful = int(doubtful)
    return net


def train(views: np.ndarray, labels: np.ndarray, seed: int = SEED) -> Network | None:
    """A network from labelled views in memory, as one shard."""
    return _learnt(Held(Shard(0, views, labels, len(views))), seed)


def dealt(found: DataFrame, size: int = SHARD) -> tuple[DataFrame, int] | None:
    """Every different labelled view of a stored result of ``candidates``, in rows (shard, views, labels) by hash, and how many shards
    there are. None without both labels."""

    def labelled(column: str, label: int) -> DataFrame:
        views = found.select(F.explode(column).alias("x")).where("not x.beyond").select(F.explode("x.views").alias("view"))
        return views.select("view", F.lit(label).alias("label"))

    once = stored(labelled("base", 1).unionAll(labelled("open", 0)).distinct(), "views")
    counts = [row["count"] for row in once.groupBy("label").count().collect()]
    if len(counts) < 2:
        return None
    count = -(-sum(counts) // size)
    mark = F.xxhash64("view")
    one = F.struct(mark.alias("mark"), "view", "label")
    grouped = once.groupBy(F.pmod(mark, F.lit(count)).alias("shard")).agg(F.array_sort(F.collect_list(one)).alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [b"".join(x.as_py()) for x in batch.column(1)]
            labels = [bytes(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(views, pa.binary()), pa.array(labels, pa.binary())], names=["shard", "views", "labels"])

    rows = grouped.select("shard", "x.view", "x.label").mapInArrow(pack, "shard long, views binary, labels binary")
    rows = stored(rows, "shards")
    return rows, rows.count()


def learn(found: DataFrame, size: int = SHARD, n_made: int = MADE) -> Network | None:
    """A network from all findings of a stored result of ``candidates``, in shards of about ``size`` views, each beside the views of
    ``n_made`` made findings of each shape."""
    shards = dealt(found, size)
    if shards is None:
        return None
    keys, harmless = made(n_made)
    return _learnt(Dealt(*shards, (as_views(keys + harmless), np.repeat(np.uint8([1, 0]), [len(keys), len(harmless)]))), SEED)


def taken(runs: list[tuple[int, int, list[bytes]]], network: Network | None, portion: int = 4096) -> list[tuple[int, int]]:
    """Start and end of the runs (start, end, views) of which a view reaches the threshold, judged in portions of views."""
    if network is None or not runs:
        return []
    views = [view for _, _, shown in runs for view in shown]
    parts = [network.scores(as_views(views[k : k + portion])) for k in range(0, len(views), portion)]
    firsts = np.cumsum([0, *(len(shown) for _, _, shown in runs[:-1])])
    best = np.maximum.reduceat(np.concatenate(parts), firsts)
    return [(s, e) for (s, e, _), score in zip(runs, best, strict=True) if score >= network.threshold]


def findings(found: DataFrame, network: Network | None, key: str = "doc_id") -> DataFrame:
    """Per row: ``key``, n_assign, n_access, n_hex, base_sha256, spans (all, as text) and places (start and end of all)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, opened in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = [(x["kind"], x["start"], x["end"]) for x in base]
                counts = [sum(x[0] == kind for x in spans) for kind in KINDS[:3]]
                digest = hashlib.sha256(written(spans).encode()).hexdigest()
                spans += [(KINDS[3], s, e) for s, e in taken([(x["start"], x["end"], x["views"]) for x in opened], network)]
                rows.append((*counts, digest, written(spans), [{"start": s, "end": e} for _, s, e in sorted(spans, key=lambda x: x[1])]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            columns = [pa.array([x[k] for x in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "places"])

    kind = found.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, places array<struct<start: int, end: int>>"
    return found.select(key, "base", "open").mapInArrow(judge, shape)


def redacted(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with all findings replaced in ``text``, other columns as they are."""
    at = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(at):
                body = value.as_py()
                base = base_findings(body or "")
                opened = [(s, e, windows(body, s, e)) for s, e, _ in open_runs(body or "", base)] if network is not None else []
                places = [(s, e) for _, s, e, _ in base] + taken(opened, network)
                texts.append(redact(body, places) if places else body)
            columns = [pa.array(texts, pa.string()) if k == at else x for k, x in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(clean, docs.schema)


def redact(text: str, places: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """``text`` with every maximal run of overlapping places replaced by ``mark``."""
    parts, at = [], 0
    until = -1
    for start, end in sorted(places):
        if start >= until:
            if until >= 0:
                at = until
            parts += [text[at:start], mark]
        until = max(until, end)
    return "".join(parts) + text[max(until, 0) :]
