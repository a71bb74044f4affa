"""Language of a text by compression: the language whose dictionary makes the text smallest.

Every language has a zstandard raw-content dictionary made of excerpts of its texts. A text is cut into blocks, each block
is compressed once with each dictionary, and the sizes are added up over the whole text. The smallest sum names the
language; when the runner-up is nearly as small the text is rejected.

Defined cases: a null text, an empty one and one without a letter have language ``und``, score 0 and are rejected. Equal
sizes go to the language that sorts first, and are rejected. Rows that repeat are each answered. An empty table gives an
empty result; without any labelled text every language is ``und``. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Dictionaries are learned from at most this many excerpts of this many characters per language, ...
EXCERPTS = 96
EXCERPT_CHARS = 1_500
#: Languages whose compressors a task holds at once; more are tried one after the other for each batch of texts.
AT_ONCE = 200
#: Cells among which a language's excerpts are chosen, so that no task sees all rows of a frequent language.
CELLS = 16
#: Bytes that are compressed at once.
BLOCK_BYTES = 4_096
LEVEL = 5
#: The runner-up must be larger by this share of the size, and by this many bytes.
MARGIN = 0.001
MARGIN_BYTES = 1

UNDETERMINED = "und"

#: Letters stay, ASCII without case; digits, signs and white space become one kind of gap.
_PLAIN = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(_PLAIN)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", excerpts: int = EXCERPTS) -> dict[str, bytes]:
    """A dictionary per language from a bounded sample of (text, lang): ``excerpts`` excerpts of each language, whatever their number.

    Rows are chosen by a hash of the text, the same at every run; a text that repeats counts once.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    rows = rows.withColumn("order", F.xxhash64("text"))
    cell = F.pmod(F.shiftright("order", 8), F.lit(CELLS)).alias("cell")
    # repeats go before the rows of a cell are ranked, so that a frequent text is one row there
    chosen = (
        rows.select("lang", "order").distinct().select("lang", "order", cell)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang", "cell").orderBy("order")))
        .where(F.col("place") <= -(-excerpts // CELLS))
        .select("lang", "order")
    )
    start = 1 + F.pmod(F.shiftright("order", 16), F.greatest(F.lit(1), F.length("text") - EXCERPT_CHARS))
    chosen = rows.join(F.broadcast(chosen), ["lang", "order"], "left_semi").withColumn("from", start)  # excerpts times languages
    chosen = chosen.select("lang", "order", F.substring("text", F.col("from"), F.lit(EXCERPT_CHARS)).alias("excerpt")).dropDuplicates(["lang", "order"])
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in chosen.select("lang", "order", "excerpt").collect():
        parts.setdefault(row["lang"], []).append((row["order"], row["excerpt"]))
    return {name: b" ".join(plain(x) for _, x in sorted(of)) for name, of in sorted(parts.items())}


class Encoders:
    """Compressors of all languages, of ``at_once`` of them at a time."""

    def __init__(self, dictionaries: dict[str, bytes], at_once: int = AT_ONCE):
        self.dictionaries = {name: content for name, content in sorted(dictionaries.items()) if len(content) >= 8}
        self.names = list(self.dictionaries)
        self.parts = [self.names[a : a + at_once] for a in range(0, len(self.names), at_once)]
        self.held = [_compressor(self.dictionaries[x]) for x in self.names] if len(self.parts) == 1 else None

    def sizes(self, texts: list[str]) -> np.ndarray:
        """Sizes of each text with each language."""
        sizes = np.zeros((len(texts), len(self.names)), np.int64)
        cut = []
        for text in texts:
            data = plain(text)
            cut.append([data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)])
        at = 0
        for names in self.parts:
            compressors = self.held or [_compressor(self.dictionaries[x]) for x in names]
            for i, blocks in enumerate(cut):
                sizes[i, at : at + len(names)] = [sum(len(c.compress(block)) for block in blocks) for c in compressors]
            at += len(names)
        return sizes

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Of each text the language, a score from 0 to 1, and whether it is rejected."""
        judged = [(UNDETERMINED, 0.0, True)] * len(texts)
        told = [i for i, x in enumerate(texts) if x and self.names and any(map(str.isalpha, x))]
        for i, sizes in zip(told, self.sizes([texts[i] for i in told]), strict=True):
            best = int(sizes.argmin())
            behind = np.delete(sizes - sizes[best], best)
            score = float(1 / (1 + np.exp(-behind / (2 + 0.01 * sizes[best])).sum()))
            narrow = len(behind) > 0 and behind.min() < max(MARGIN_BYTES, MARGIN * sizes[best])
            judged[i] = self.names[best], score, bool(narrow)
        return judged


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, lang_pred, score, rejected. The dictionaries are bounded by ``learn``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(dictionaries)
        for batch in batches:
            judged = encoders.judge(batch.column(1).to_pylist())
            columns = [pa.array([x[k] for x in judged], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "lang_pred", "score", "rejected"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(judge, f"`{key}` {kind}, lang_pred string, score double, rejected boolean")


def told(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` without the rejected texts, all columns kept."""
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders(dictionaries)
        for batch in batches:
            yield batch.filter(pa.array([not rejected for *_, rejected in encoders.judge(batch.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
