"""URLs judged by ordered host and path rules, and beyond them by exact membership in a list of hosts.

Membership is a cascade of Bloom filters. The first level holds the listed hosts. The second holds those hosts of the whole
corpus that are not listed and that the first one lets through; the third the listed ones the second lets through, and so
on, until nothing is let through wrongly. As the levels are made over all hosts that occur, the answer is exact for each of
them, and judging a page needs no join: the levels are scalar subqueries over one stored row each.

The levels' size follows the list. A list of more than SHARD_LISTED hosts is cut into shards by a hash of the host, each of which has
a cascade of its own over its hosts of the universe: keys and pages are stored in a folder per shard, without a shuffle, and
shards are judged one after the other, so that a task and the driver hold the filters of one shard. A very common host's pages
stay in as many tasks as files hold them. All work is in built-in expressions.

Defined cases: a null URL and one without ``://`` have an empty host and path, no rule and verdict allow. Repeated rows are
each judged. An empty list blocks nothing. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.tables import stored

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Hosts are listed when a part of their name holds one of these.
LISTED_TERMS = ("spam", "casino", "pills", "bets", "adult", "ads")
#: Listed hosts of one cascade: 8 bits a host are 4 MB for the first level.
SHARD_LISTED = 4_000_000
#: Bits for each key and places set for it, at the first level and at the later ones.
FIRST, LATER = (8, 5), (6, 4)
WORD = 64


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host in lower case and path of the URL column ``url``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, shape, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text = verdict = F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda x: len(x[1] + x[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(name + start)).otherwise(text), F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def listed_hosts(pages: DataFrame, url: str = "url", terms=LISTED_TERMS) -> DataFrame:
    """One row ``host`` for each host of ``pages`` with one of ``terms`` in its name: the list the queries use."""
    hosts = pages.select(host_and_path(url)[0].alias("host")).distinct()
    return hosts.where(F.col("host").rlike("|".join(terms)))


@dataclass
class Level:
    bits: int
    places: int
    seed: int
    words: DataFrame  # one row, words: array<bigint>

    def holds(self, key: Column) -> Column:
        words = self.words.select("words").scalar()
        found = F.lit(True)
        for place in _places(key, self.bits, self.places, self.seed):
            word = F.element_at(words, (F.floor(place / WORD) + 1).cast("int"))
            found = found & (F.expr("1L") == F.getbit(word, F.pmod(place, F.lit(WORD)).cast("int")).cast("long"))
        return found


def _places(key: Column, bits: int, places: int, seed: int) -> list[Column]:
    """``places`` bit numbers of a key, from two hashes."""
    one, two = F.xxhash64(key, F.lit(seed)), F.xxhash64(F.lit(seed), key)
    return [F.pmod(F.pmod(one, F.lit(bits)) + k * F.pmod(two, F.lit(bits)), F.lit(bits)) for k in range(places)]


def _level(keys: DataFrame, n: int, number: int) -> Level:
    """A filter over ``keys`` (key), as one stored row of 64-bit words."""
    per_key, places = FIRST if number == 0 else LATER
    bits = max(WORD, -(-n * per_key // WORD) * WORD)
    place = F.explode(F.array(*_places(F.col("key"), bits, places, number)))
    words = (
        keys.select(place.alias("place"))
        .groupBy(F.floor(F.col("place") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")).alias("bits"))
    )
    held = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    row = words.agg(held.alias("held")).select(
        F.transform(F.sequence(F.lit(0), F.lit(bits // WORD - 1)), lambda i: F.coalesce(F.element_at("held", i), F.expr("0L"))).alias("words")
    )
    return Level(bits, places, number, stored(row, "filter"))


def cascade(keys: DataFrame) -> list[Level]:
    """Levels that tell the listed ones among ``keys`` (key, listed), a stored table of all keys, from the others."""
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    levels: list[Level] = []
    n = inside.count()
    while n:
        level = _level(inside, n, len(levels))
        levels.append(level)
        passed = stored(outside.where(level.holds(F.col("key"))), "passed")
        inside, outside, n = passed, inside, passed.count()
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """The first level that does not hold the key decides: not listed at the first, third, ... one, else listed."""
    answer = F.lit(len(levels) % 2 == 1)
    for k in reversed(range(len(levels))):
        answer = F.when(~levels[k].holds(key), F.lit(k % 2 == 1)).otherwise(answer)
    return answer


def judge(pages: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, shard_listed: int = SHARD_LISTED) -> DataFrame:
    """Per page: ``key``, host, path, rule, verdict. ``listed`` (host) is what the method blocks; a cascade holds about
    ``shard_listed`` of them."""
    host, path = host_and_path(url)
    read = pages.select(key, host.alias("host"), path.alias("path"))
    universe = read.select(F.col("host").alias("key")).distinct()
    listed = listed.where("host is not null and host <> ''").select(F.col("host").alias("key")).distinct().withColumn("listed", F.lit(True))
    keys = stored(universe.join(listed, "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False))), "hosts")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)

    def judged(rows: DataFrame, levels: list[Level]) -> DataFrame:
        own = F.when(is_listed(F.col("host"), levels), F.lit("block")).otherwise(F.lit("allow"))
        return rows.select(key, "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))

    shards = -(-keys.where("listed").count() // shard_listed)
    if shards <= 1:
        return judged(read, cascade(keys))
    keys = stored(keys.withColumn("shard", _shard(F.col("key"), shards)), "sharded_hosts", "shard")
    read = stored(read.withColumn("shard", _shard(F.col("host"), shards)), "sharded_pages", "shard")
    parts = [stored(judged(read.where(F.col("shard") == k), cascade(keys.where(F.col("shard") == k).drop("shard"))), "judged") for k in range(shards)]
    return reduce(DataFrame.unionAll, parts)


def _shard(host: Column, shards: int) -> Column:
    """A shard number by a hash that no level uses."""
    return F.pmod(F.xxhash64(F.lit("shard"), host), F.lit(shards)).cast("int")


def oracle(rules=RULES, terms=LISTED_TERMS) -> str:
    """The same answers over ``pages`` in SQL, the list asked plainly."""
    cases = [(f"host = '{h}' or host like '%.{h}'", p, h + p, v) for v, h, p in sorted(rules, key=lambda x: -len(x[1] + x[2]))]
    when = lambda k: "case " + " ".join(f"when ({c[0]}) and starts_with(path, '{c[1]}') then '{c[k]}'" for c in cases)
    return f"""
    with parts as (
      select page_id, case when contains(url, '://') then substr(url, position('://' in url) + 3) else '' end as rest from pages
    ), read as (
      select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
      from parts
    )
    select page_id, host, path, {when(2)} end as rule,
           {when(3)} else case when regexp_matches(host, '{"|".join(terms)}') then 'block' else 'allow' end end as verdict
    from read
    """
