"""Language identification with bit-sliced Bloom filters over byte 4-grams.

Fitting counts, for each language, how often each 4-gram occurs and in how many labelled texts, on at most about
``SAMPLE_TEXTS`` texts of a language (chosen by a hash of id and text).  A 4-gram belongs to a language if it occurs in
``MIN_RATE`` of its texts and its share of the language's 4-grams, whatever the texts' lengths, is at least
``MIN_RATIO`` times that of each other language.  What other languages are taken to have is a cautious share: it is
lessened by ``CAUTION`` deviations of the number n of texts that the 4-gram is in, 1 - ``CAUTION`` / sqrt(n), and
a language of fewer than ``MIN_TEXTS`` texts takes nothing from others.
One table of cells holds all languages' Bloom filters: bit ``l`` of a cell belongs to language ``l``, so that ANDing
the ``HASHES`` cells of a 4-gram gives the mask of all languages that contain it.  A text's counts are the popcounts
of each bit over all its 4-grams, less the false positives to be expected from that bit's share of set cells; the
largest corrected count decides.

Texts are lower-cased, runs of anything but letters (and other non-ASCII characters) become one space.

Cases: a null text, one without a letter, or a fit without labelled texts gives ``und`` with score 0; a text with
letters but no known 4-gram gets the language of most labelled texts, with score 0; ties go to the language with more
labelled texts, then by name; at most 64 languages.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_signals.llm.common import arrow_map, release, staged
from merchant_signals.llm.words import LOWER, chunks, mix, texts_of

#: Bound of the labelled texts of a language that are counted.
SAMPLE_TEXTS = 4000
#: Share of a language's texts that a 4-gram has to be in, and the least ratio of its share of all 4-grams to the largest
#: cautious share of any language.
MIN_RATE, MIN_RATIO = 0.01, 0.5
#: Texts that a language needs to lower others' 4-grams; deviations that its shares are lessened by.
MIN_TEXTS, CAUTION = 10, 2.0
#: Hash functions, and cells for each 4-gram of the largest language.
HASHES, CELLS_PER_GRAM = 4, 16
UNDETERMINED = "und"
#: Bytes whose 4-grams are handled at once, and texts that are prepared at once.
CHUNK, TEXTS = 1 << 18, 512
#: Counts that are kept before equal keys are summed.
PENDING = 1 << 20

_KEEP = np.array([b > 127 or 97 <= b <= 122 for b in range(256)])


def _prepared(column: pa.Array) -> pa.Array:
    lower = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    space = pa.scalar(" ", pa.large_string())
    return pc.binary_join_element_wise(space, lower, space, pa.scalar("", pa.large_string()))


def grams(column: pa.Array):
    """Chunk by chunk: number of the first text, number of texts, each 4-gram's value and its text's number."""
    data, offset = texts_of(_prepared(column))
    for i, j in chunks(offset, CHUNK):
        b, off = data[offset[i]:offset[j]], offset[i:j + 1] - offset[i]
        inside = _KEEP[LOWER[b]]
        kept = inside.copy()
        kept[1:] |= inside[:-1]  # of each run of others, its first
        kept[off[:-1]] = True  # each text starts with a space
        at = np.concatenate([[0], np.cumsum(kept)])[off]
        c = np.where(inside, b, 32)[kept].astype(np.uint32)
        if len(c) < 4:
            yield i, j - i, np.zeros(0, np.uint32), np.zeros(0, np.int64)
            continue
        v = c[:-3] | c[1:-2] << np.uint32(8) | c[2:-1] << np.uint32(16) | c[3:] << np.uint32(24)
        row = np.repeat(np.arange(j - i), np.diff(at))
        same = row[:-3] == row[3:]
        yield i, j - i, v[same], row[:-3][same]


def _cells(gram: np.ndarray, size: int) -> Iterator[np.ndarray]:
    h = mix(gram.astype(np.uint64), 7)
    lo, hi = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (((lo + np.uint64(k) * hi) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES))


@dataclass
class LanguageModel:
    languages: list[str]  # most labelled texts first
    table: np.ndarray  # of cells with a bit for each language
    id: str = field(default_factory=lambda: uuid.uuid4().hex)

    @classmethod
    def build(cls, grams_of: dict[str, np.ndarray]) -> "LanguageModel":
        most = max([1, *(len(g) for g in grams_of.values())])
        size = 1 << int(np.ceil(np.log2(most * CELLS_PER_GRAM)))
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(grams_of) <= 8 * np.dtype(k).itemsize)
        table = np.zeros(size, kind)
        for bit, own in enumerate(grams_of.values()):
            for cell in _cells(own, size):
                table[cell] |= kind(1 << bit)
        return cls(list(grams_of), table)

    def false_positive_rates(self) -> np.ndarray:
        return np.array([float(((self.table >> self.table.dtype.type(k)) & self.table.dtype.type(1)).mean()) ** HASHES
                         for k in range(len(self.languages))])

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected popcounts (texts x languages) and numbers of 4-grams."""
        found, total = np.zeros((len(column), len(self.languages))), np.zeros(len(column))
        for i, n, v, row in grams(column):
            cells = _cells(v, len(self.table))
            mask = self.table[next(cells)]
            for c in cells:
                mask &= self.table[c]
            at = np.searchsorted(row, np.arange(n + 1))
            total[i:i + n] = np.diff(at)
            for k in range(len(self.languages)):
                hit = np.concatenate([[0], np.cumsum((mask >> mask.dtype.type(k)) & mask.dtype.type(1), dtype=np.int64)])
                found[i:i + n, k] = np.diff(hit[at])
        rate = self.false_positive_rates()
        return np.maximum(0.0, (found - total[:, None] * rate) / (1 - rate)), total

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, its share of all languages' counts, and the share of the text's 4-grams that it explains."""
        letter = pc.fill_null(pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}"), False)
        letter = letter.to_numpy(zero_copy_only=False)
        if not self.languages:
            return [UNDETERMINED] * len(column), np.zeros(len(column)), np.zeros(len(column))
        count, total = self.counts(column)
        best = count.argmax(axis=1)
        top = count[np.arange(len(best)), best] * letter
        name = [self.languages[k] if ok else UNDETERMINED for k, ok in zip(best, letter)]
        return name, top / np.maximum(count.sum(axis=1), 1e-9), top / np.maximum(total, 1)


def _summed(parts: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    """Keys, each once, with the sums of their counts."""
    key, *counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return [(key[at], *(np.add.reduceat(c[order], at) if len(at) else c for c in counts))]


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    own = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)).alias("h"))
    sizes = own.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(65).collect()
    if len(sizes) > 64:
        raise ValueError("a cell has a bit for each of 64 languages at most")
    share = F.lit(None).cast("long")
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(int((1 << 30) * min(1.0, sample_texts / r["count"])))).otherwise(share)
    sample = own.where(F.col("h") < share).select("lang", "text")

    def count(b: pa.RecordBatch) -> pa.RecordBatch:
        name = b.column("lang").dictionary_encode()
        code, names = name.indices.to_numpy(zero_copy_only=False), name.dictionary.to_pylist()
        parts, pending = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        for first in range(0, b.num_rows, TEXTS):
            for i, n, v, row in grams(b.column("text").slice(first, TEXTS)):
                key, often = np.unique((row.astype(np.uint64) << np.uint64(32)) | v, return_counts=True)  # once for each text
                lang = code[first + i + (key >> np.uint64(32)).astype(np.int64)].astype(np.uint64)
                parts.append(((lang << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF)), np.ones(len(key), np.int64), often))
                pending += len(key)
                if pending > PENDING:
                    parts, pending = _summed(parts), 0
        key, n, often = _summed(parts)[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()).take(pa.array((key >> np.uint64(32)).astype(np.int64))),
             pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n), pa.array(often)], names=["lang", "gram", "n", "often"])

    texts = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    counts = staged(arrow_map(sample, count, "lang string, gram bigint, n bigint, often bigint").groupBy("lang", "gram")
                    .agg(F.sum("n").alias("n"), F.sum("often").alias("often")), "language-grams")
    total = {r["lang"]: r["often"] for r in counts.groupBy("lang").agg(F.sum("often").alias("often")).collect()}
    rate, share, caution = (F.lit(None).cast("double") for _ in range(3))
    for lang, n in texts.items():
        own = F.col("lang") == lang
        rate = F.when(own, F.col("n") / F.lit(float(n))).otherwise(rate)
        share = F.when(own, F.col("often") / F.lit(float(total.get(lang, 1)))).otherwise(share)
        caution = F.when(own, F.greatest(F.lit(0.0), 1 - F.lit(CAUTION) / F.sqrt("n")) if n >= MIN_TEXTS else F.lit(0.0)).otherwise(caution)
    shares = counts.select("lang", "gram", rate.alias("rate"), share.alias("share"), (share * caution).alias("sure"))
    top = shares.groupBy("gram").agg(F.max("sure").alias("top"))
    # a text of average length has few thousand distinct 4-grams, so few hundred thousand reach MIN_RATE
    kept = (shares.where(F.col("rate") >= MIN_RATE).join(top, "gram")
            .where(F.col("share") >= MIN_RATIO * F.col("top")).select("lang", "gram").toPandas())
    release(counts)
    return LanguageModel.build({r["lang"]: kept.loc[kept["lang"] == r["lang"], "gram"].to_numpy(np.uint64)
                                for r in sizes if r["lang"] in texts})


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Adds lang_pred, score (its share of all languages' corrected counts) and coverage (the share of the text's
    4-grams that it explains). Columns of these names are replaced."""
    added = ("lang_pred", "score", "coverage")
    df = docs.select(*[c for c in docs.columns if c.lower() not in added])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("coverage", T.DoubleType())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        text = b.column(text_col)
        parts = [shared.value.predict(text.slice(i, TEXTS)) for i in range(0, b.num_rows, TEXTS)]
        name, score, coverage = ([x for p in parts for x in p[k]] for k in range(3))
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(name, pa.string()), pa.array(score, pa.float64()),
                                           pa.array(coverage, pa.float64())], names=[*b.schema.names, *added])

    return arrow_map(df, run, schema)


def held_out(doc_id) -> "F.Column":
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def fit_on_documents(spark: SparkSession, docs: DataFrame) -> LanguageModel:
    """The model of the labelled documents that aren't held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))))
