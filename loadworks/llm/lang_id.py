"""Language identification with bit-sliced n-gram Bloom filters.

``fit`` learns, for each language, the byte 4-grams (letters lower-cased,
anything else one blank) that are typical of it.  All languages share one
Bloom filter whose slots are bit masks: bit l of a slot belongs to language l.
The AND of an n-gram's slots names every language that (probably) holds it,
so one lookup serves all languages.  ``predict`` counts the set bits of each
language over a text, takes away what false positives explain, and the
highest count decides.

Defined results: a text that is null or has no letter is ``und`` with score 0;
equal counts go to the smaller language name; an empty training set leaves
only ``und``; the training rows with null language or text are not used, nor
those of languages beyond the ``languages`` most frequent ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadworks.llm.columns import mix, slices, sums, utf8, with_columns
from loadworks.llm.components import stored

LANGUAGES = 256           # languages learned, at most: those of most training texts
SAMPLE_DOCS = 4000        # training texts of a language, about
GRAMS = 20000             # n-grams of a language, at most
RATIO = 0.25              # kept where its rate is this share of its highest rate, at least
HASHES = 4
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x41:0x5B] = _FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_MARK = 0x02
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


@dataclass
class Filters:
    """Bit-sliced filters: masks[slot, word] with one bit a language."""

    languages: list[str]
    masks: np.ndarray
    false_positive: np.ndarray


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-grams of a run of texts and the first gram of each; no gram crosses two texts."""
    n = len(offsets) - 1
    grams = np.zeros(0, np.uint32)
    # a mark and a blank before each text, a blank and a mark behind it: one letter has two grams
    folded = np.full(len(data) + 4 * n, 0x20, np.uint8)
    where = np.arange(len(data)) + np.repeat(4 * np.arange(n) + 2, np.diff(offsets))
    folded[where] = _FOLD[data]
    bounds = offsets + 4 * np.arange(n + 1)
    folded[bounds[:-1]] = folded[bounds[1:] - 1] = _MARK
    blank = folded == 0x20
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    folded = folded[keep]
    kept = np.concatenate([[0], np.cumsum(keep)])
    bounds = kept[bounds]
    if len(folded) >= 4:
        wide = folded.astype(np.uint32)
        grams = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    ends = np.maximum(bounds[1:] - 3, bounds[:-1])  # grams that start in a text's last three bytes cross
    inside = np.zeros(len(grams) + 1, np.int64)
    np.add.at(inside, np.minimum(bounds[:-1], len(grams)), 1)
    np.add.at(inside, np.minimum(ends, len(grams)), -1)
    ok = np.cumsum(inside[:-1]) > 0
    count = np.concatenate([[0], np.cumsum(ok)])
    return grams[ok], count[np.minimum(bounds, len(grams))]


def _count_task(batches):
    """(lang, gram, n) of the training texts of a task, summed within each batch."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        langs = np.array(batch.column(0).to_pylist(), object)
        out: dict[str, list] = {}
        for i, j in slices(offsets):
            grams, first = _grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            of = np.repeat(np.arange(j - i), np.diff(first))
            for lang in set(langs[i:j]):
                out.setdefault(lang, []).append(grams[langs[i:j][of] == lang])
        for lang, parts in out.items():
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(values)), pa.array(values.astype(np.int64)),
                 pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])


def _slots(grams: np.ndarray, size: int) -> list[np.ndarray]:
    h = mix(grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64) for k in range(HASHES)]


def _slot_task(languages: list[str], size: int):
    """(bit, slot) of the n-grams of a task: bit is the language's place, slot one of the gram's."""
    bits = {lang: bit for bit, lang in enumerate(languages)}

    def task(batches):
        for batch in batches:
            bit = np.array([bits[lang] for lang in batch.column(0).to_pylist()], np.int64)
            slots = np.concatenate(_slots(batch.column(1).to_numpy(), size))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(bit, HASHES)), pa.array(slots)], names=["bit", "slot"])

    return task


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS, grams: int = GRAMS, ratio: float = RATIO,
        languages: int = LANGUAGES) -> Filters:
    """Learn the filters from labelled texts.

    The ``languages`` values of most labelled texts are learned (ties: the smaller
    name), from about ``sample_docs`` texts of each (whole, chosen by a hash of
    their id), with at most ``grams`` n-grams of each.  The masks are put
    together by aggregation: the driver receives one number for a slot and 64
    languages, at most some 25 MB, however many values the language column has.
    """
    rows = (train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")))
    cut = (rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
           .select("lang", (F.lit(float(sample_docs)) / F.col("n") * (1 << 30)).alias("cut")))
    sample = (rows.join(F.broadcast(cut), "lang")  # a row a learned language
              .where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.col("cut")).select("lang", "text"))
    counted = (sample.mapInArrow(_count_task, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counted = stored(counted, "grams")
    by_lang = Window.partitionBy("lang")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counted.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram")))
    kept = stored(best.where(F.col("rate") >= ratio * F.col("top"))
                  .withColumn("rank", F.row_number().over(by_lang.orderBy(F.desc("n"), "gram")))
                  .where(F.col("rank") <= grams).select("lang", "gram"), "typical-grams")
    learned = sorted(r["lang"] for r in kept.select("lang").distinct().collect())
    size = 1 << int(np.ceil(np.log2(max(1024, 12 * grams))))
    slots = stored(kept.mapInArrow(_slot_task(learned, size), "bit long, slot long").distinct(), "slots")
    fill = np.zeros(len(learned))
    for r in slots.groupBy("bit").count().collect():  # a row a learned language
        fill[r["bit"]] = r["count"] / size
    made = (slots.groupBy("slot", F.expr("bit div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("mask")).toArrow())
    masks = np.zeros((size, max(1, -(-len(learned) // 64))), np.uint64)
    masks[made["slot"].to_numpy(), made["word"].to_numpy()] = made["mask"].to_numpy().view(np.uint64)
    return Filters(learned, masks, fill ** HASHES)


def score_batch(texts: pa.Array, model: Filters) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score (corrected share of the winner's n-grams) and n-grams of each text."""
    data, offsets = utf8(texts)
    names, scores, sizes = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    size, fp = len(model.masks), model.false_positive
    for i, j in slices(offsets):
        part = data[offsets[i]:offsets[j]]
        grams, first = _grams(part, offsets[i:j + 1] - offsets[i])
        total = sizes[i:j] = np.diff(first)
        hit = None
        for slot in _slots(grams, size):
            hit = model.masks[slot] if hit is None else hit & model.masks[slot]
        if not model.languages:
            continue
        counts = np.stack([sums((hit[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1), first)
                           for b in range(len(model.languages))], axis=1)
        corrected = np.maximum(0, (counts - total[:, None] * fp) / (1 - fp))
        winner = corrected.argmax(axis=1)  # the first of equal ones: languages are sorted
        share = corrected[np.arange(j - i), winner] / np.maximum(total, 1)
        ascii_letters = sums(_ASCII_LETTER[part], offsets[i:j + 1] - offsets[i])
        for k in range(j - i):
            if ascii_letters[k] or any(map(str.isalpha, texts[i + k].as_py() or "")):
                names[i + k] = model.languages[winner[k]]
                scores[i + k] = min(1.0, share[k])
    return names, scores, sizes


def predict(docs: DataFrame, model: Filters, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and n_grams, in place: no shuffle.

    The model is a few megabytes whatever the size of the corpus (see ``fit``)
    and reaches the executors as a broadcast variable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array):
        names, scores, sizes = score_batch(texts, shared.value)
        return pa.array(names, pa.string()), pa.array(scores), pa.array(sizes)

    return with_columns(docs, [text_col], "lang_pred string, score double, n_grams long", make)
