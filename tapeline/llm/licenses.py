"""Licenses named in texts, by ordered signature rules.

A text is read as its words, lower-cased and joined by single spaces, so that punctuation and line breaks do not matter.
Three phrases are looked for in every text (the base). The signatures are regular expressions over the words: each license's
names in each of the frames in which licenses are given, the most telling frame first. A signature is only tried on texts
that hold a word common to all licenses and the signature's own keyword, which stands in every text that it matches. A detection inside another one of the same text is
dropped, and of two over the same words the one of the earlier signature stays.

All work is in built-in expressions: array functions, a generator and a window over the detections of one text.

Defined cases: a null or empty text has no words, no places, empty labels and score 0. Rows that repeat are each answered.
An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words: runs of digits, letters and all characters beyond ASCII. Lower-casing does not change which characters these are.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrase and label.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: (label, keyword, names as a regular expression over words). All names of a row hold its keyword as whole words.
LICENSES = (
    ("mit", "mit", "mit(?: x11)?"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)?(?: 2(?: 0)?)"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1"),
    ("agpl-3", "affero", "(?:gnu )?affero general public license(?: version)?(?: 3(?: 0)?)?"),
    ("agpl-3", "agpl", "(?:gnu )?agpl(?: version)?(?: v?3(?: 0)?)?"),
    ("agpl-3", "agplv3", "(?:gnu )?agplv3(?: 0)?"),
    ("agpl-3", "agpl3", "(?:gnu )?agpl3(?: 0)?"),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public license(?: version)?(?: 3(?: 0)?)"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public license(?: version)?(?: 2 1)?"),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl(?: version)?(?: v?3(?: 0)?)"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl(?: version)?(?: v?2 1)?"),
    ("lgpl-3", "lgplv3", "(?:gnu )?lgplv3(?: 0)?"),
    ("lgpl-3", "lgpl3", "(?:gnu )?lgpl3(?: 0)?"),
    ("lgpl-2.1", "lgplv2", "(?:gnu )?lgplv2(?: 1)?"),
    ("lgpl-2.1", "lgpl2", "(?:gnu )?lgpl2(?: 1)?"),
    ("gpl-3", "general", "(?:gnu )?general public license(?: version)?(?: v?3(?: 0)?)"),
    ("gpl-2", "general", "(?:gnu )?general public license(?: version)?(?: v?2(?: 0)?)?"),
    ("gpl-3", "gpl", "(?:gnu )?gpl(?: version ?| )v?3(?: 0)?"),
    ("gpl-2", "gpl", "(?:gnu )?gpl(?:(?: version ?| )v?2(?: 0)?| version)?"),
    ("gpl-3", "gplv3", "(?:gnu )?gplv3(?: 0)?"),
    ("gpl-3", "gpl3", "(?:gnu )?gpl3(?: 0)?"),
    ("gpl-2", "gplv2", "(?:gnu )?gplv2(?: 0)?"),
    ("gpl-2", "gpl2", "(?:gnu )?gpl2(?: 0)?"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)"),
    ("bsd-2-clause", "freebsd", "freebsd"),
    ("bsd-3-clause", "bsd", "(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd)"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)"),
    ("bsd", "bsd", "bsd(?: style)?"),
    ("0bsd", "0bsd", "0bsd"),
    ("0bsd", "zero clause", "zero clause bsd"),
    ("mpl-2", "mozilla", "mozilla public license(?: version)?(?: v? ?2(?: 0)?)"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version)? 1 1"),
    ("mpl-2", "mpl", "mpl(?: version ?| )v?2(?: 0)?"),
    ("mpl-2", "mplv2", "mplv2(?: 0)?"),
    ("mpl-2", "mpl2", "mpl2(?: 0)?"),
    ("epl-2", "eclipse", "eclipse public license(?: version)?(?: v? ?2(?: 0)?)?"),
    ("epl-1", "eclipse", "eclipse public license(?: version)?(?: v? ?1(?: 0)?)"),
    ("cddl-1", "cddl", "cddl(?: version)?(?: 1(?: [01])?)?"),
    ("cddl-1", "distribution license", "common development and distribution license(?: version)?(?: 1(?: [01])?)?"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("artistic-2", "artistic", "artistic(?: license)?(?: version)?(?: 2(?: 0)?)?"),
    ("boost-1", "boost", "boost software license(?: version)?(?: 1 0)?"),
    ("eupl-1.2", "eupl", "eupl(?: version)?(?: v? ?1 2)?"),
    ("eupl-1.2", "union public", "european union public licence(?: version)?(?: v? ?1 2)?"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("ofl-1.1", "ofl", "(?:sil )?ofl(?: version)?(?: 1 1)?"),
    ("ofl-1.1", "font license", "(?:sil )?open font license(?: version)?(?: 1 1)?"),
    ("cc0", "cc0", "(?:creative commons )?cc0(?: 1 0)?"),
    ("cc-by", "cc", "cc by(?: [1-4] 0)?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1-4] 0)?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1-4] 0)?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1-4] 0)?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1-4] 0)?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1-4] 0)?"),
    ("cc-by", "commons", "creative commons attribution(?: [1-4] 0)?"),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike(?: [1-4] 0)?"),
    ("cc-by-nd", "commons", "creative commons attribution no ?deriv(?:ative)?s(?: [1-4] 0)?"),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial(?: [1-4] 0)?"),
    ("cc-by-nc-sa", "commons", "creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?"),
    ("proprietary", "rights", "all rights reserved"),
)
#: Frames in which a license is given, the most telling first; NAME stands for the license's names.
FRAMES = (
    "spdx license identifier NAME",
    "(?:released|distributed|provided|made available) under the (?:terms|conditions) of the NAME(?: licen[cs]e)?",
    "(?:released|licen[cs]ed|distributed|available|provided|published) under (?:the |an? )?NAME(?: international)?(?: licen[cs]e)?",
    "(?:subject to|covered by|governed by) (?:the |an? )?NAME(?: licen[cs]e)?",
    "licen[cs]e(?:d)? (?:is |as )?(?:the )?NAME",
    "(?:the )?NAME licen[cs]e",
)
#: A text without any of these, with whatever stands between their words, holds no signature.
GATE = "licen[cs]e|spdx|(?:released|distributed|available|provided|published|subject to|covered by|governed by)|all rights reserved"


def signatures(licenses=LICENSES, frames=FRAMES) -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, pattern): every license in every frame, frames first."""
    pairs = [(frame, *row) for frame in frames for row in licenses if row[0] != "proprietary"]
    rules = [(label, keyword, " " + frame.replace("NAME", names) + "(?= )") for frame, label, keyword, names in pairs]
    rules += [(label, keyword, " " + names + "(?= )") for label, keyword, names in licenses if label == "proprietary"]
    return [(k, *rule) for k, rule in enumerate(rules)]


def as_words(text: str) -> Column:
    """The words of a text in lower case, each with a space before it, and one at the end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), GAP, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _maybe_base(text: str) -> Column:
    """Holds wherever a base phrase can stand, and seldom elsewhere."""
    lowered = F.lower(text)
    return lowered.contains("license") | lowered.rlike(r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+by[\x00-\x2F\x3A-\x60\x7B-\x7F]+nc")


def base(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=BASE) -> DataFrame:
    """Per row: ``key``, hashed (of the text), n_words, n_base, first_word, last_word, found (base labels)."""
    read = docs.select(
        key,
        F.xxhash64(text).alias("hashed"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.when(_maybe_base(text), as_words(text)).alias("words"),
    )
    parts = {label: F.split("words", f" {phrase}(?= )", -1) for phrase, label in phrases}
    read = read.withColumns({f"_{label}": x for label, x in parts.items()})
    size = lambda label: F.coalesce(F.size(f"_{label}") - 1, F.lit(0))
    first = lambda label: F.when(size(label) > 0, _spaces(F.element_at(f"_{label}", 1)))
    last = lambda phrase, label: F.when(
        size(label) > 0, F.col("n_words") - (_spaces(F.element_at(f"_{label}", -1)) - 1) - len(phrase.split())
    )
    labels = F.array(*(F.when(size(label) > 0, F.lit(label)) for _, label in phrases))
    return read.select(
        key,
        "hashed",
        "n_words",
        sum((size(label) for _, label in phrases), F.lit(0)).cast("long").alias("n_base"),
        F.least(*(first(label) for _, label in phrases)).alias("first_word"),
        F.greatest(*(last(phrase, label) for phrase, label in phrases)).alias("last_word"),
        F.array_compact(labels).alias("found"),
    )


def detections(docs: DataFrame, key: str = "doc_id", text: str = "text", rules=None) -> DataFrame:
    """Detections that stay: ``key``, hashed, label, priority, first_word, n_words; one row each."""
    rules = signatures() if rules is None else rules
    table = F.array(*(F.struct(F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(f" {k} ").alias("keyword"), F.lit(x).alias("pattern")) for p, label, k, x in rules))
    keywords = "|".join(sorted({k for _, _, k, _ in rules}))
    lowered = F.lower(text)
    gated = docs.where(lowered.rlike(keywords.replace(" ", GAP)) & lowered.rlike(GATE.replace(" ", GAP)))
    words = gated.select(key, F.xxhash64(text).alias("hashed"), as_words(text).alias("words")).distinct()
    tried = words.select(key, "hashed", "words", F.explode(F.filter(table, lambda r: F.col("words").contains(r["keyword"]))).alias("rule"))
    matched = tried.select(
        key,
        "hashed",
        "rule",
        F.split(F.col("words"), F.col("rule.pattern"), -1).alias("parts"),
        F.regexp_extract_all("words", F.col("rule.pattern"), F.lit(0)).alias("hits"),
    ).where(F.size("hits") > 0)
    each = matched.select(key, "hashed", "rule", F.posexplode(F.arrays_zip("parts", "hits")).alias("place", "x"))
    before = Window.partitionBy(key, "hashed", "rule.priority").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.select(
        key,
        "hashed",
        F.col("rule.label").alias("label"),
        F.col("rule.priority").alias("priority"),
        (F.coalesce(F.sum(_spaces(F.col("x.parts")) + _spaces(F.coalesce("x.hits", F.lit("")))).over(before), F.lit(0)) + _spaces(F.col("x.parts"))).alias("first_word"),
        _spaces(F.col("x.hits")).alias("n_words"),
    ).where("n_words is not null")
    ahead = Window.partitionBy(key, "hashed").orderBy("first_word", F.desc("n_words"), "priority").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.col("first_word") + F.col("n_words")).over(ahead)
    return placed.withColumn("reach", reach).where("reach is null or reach < first_word + n_words").drop("reach")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=BASE, rules=None) -> DataFrame:
    """Per row: ``key``, n_words, n_base, first_word, last_word, base_labels, labels, score (share of words in detections)."""
    found = detections(docs, key, text, rules).groupBy(F.col(key).alias("_key"), F.col("hashed").alias("_hashed")).agg(
        F.collect_set("label").alias("_more"), F.sum("n_words").alias("_covered")  # at most one label for each license
    )
    read = base(docs, key, text, phrases)
    both = read.join(found, read[key].eqNullSafe(F.col("_key")) & (F.col("hashed") == F.col("_hashed")), "left")
    named = sum((F.when(F.array_contains("found", label), len(phrase.split())).otherwise(0) for phrase, label in phrases), F.lit(0))
    covered = F.greatest(F.coalesce("_covered", F.lit(0)), named)
    return both.select(
        key,
        F.col("n_words"),
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("found"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("found", F.coalesce("_more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_words") > 0, F.least(F.lit(1.0), covered / F.col("n_words"))).otherwise(0.0).alias("score"),
    )
