"""Toxicity: gradient-boosted trees over dense measures of a text, calibrated by isotonic regression.

The lexicon has two parts: insults that are fixed here, and words that the labels themselves show to
be toxic, whatever their language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.texts import (
    Texts,
    Words,
    find_words,
    lower_ascii,
    per_text,
    ranked,
    slices,
    window_hashes,
    word_hashes,
)
from brindle.session import materialize

# Insults, as a whole word of a text; spelt without accents where both spellings are common.
INSULTS = """
    airhead arsehole asshole bastard bitch blockhead bonehead brainless braindead bullshit buffoon
    clown cockroach coward cretin creep crap cunt degenerate despicable dickhead dimwit dipshit
    disgusting disgrace douche douchebag dumb dumbass dummy dunce fool filth filthy freak fuck fucker
    fucking garbage goon halfwit hypocrite idiot idiotic idiots imbecile imbecilic jackass jerk
    knucklehead liar loser losers lowlife maggot moron moronic morons motherfucker nitwit numbskull
    obnoxious parasite pathetic pervert phony pig piss prick psycho puke repulsive retard retarded scum
    scumbag shit shithead shitty simpleton skank slime slimeball slut sociopath stinking stupid
    stupidity sucker thug tosser traitor trash troll twat twit useless vermin vile wanker weakling
    weirdo whore wimp worthless wretch
    abschaum arschloch bloedmann dummkopf drecksau hurensohn idioten schlampe schwachkopf trottel
    vollidiot wichser scheisse
    abruti connard connasse cretins debile encule imbeciles merde ordure salaud salope
    basura cabron estupido estupida gilipollas imbecil mierda pendejo subnormal
""".split()
# Words that address the reader.
SECOND_PERSON = """
    you your yours yourself yourselves ya ye u ur youre you're you've you'll you'd
    du dich dir dein deine deinen deiner euch euer eure ihr
    tu toi te ton ta tes vous votre vos
    tú tus ti usted ustedes vosotros vuestro vuestra eres
""".split()

MEASURES = (
    "log_words",
    "insult_density",
    "log_insults",
    "log_kinds",
    "learnt_density",
    "log_learnt",
    "log_learnt_kinds",
    "near_density",
    "near_share",
    "person_density",
    "hidden_density",
    "log_hidden",
    "masked_density",
    "spaced_density",
    "stretched_density",
    "upper_letters",
    "upper_words",
    "shouts",
    "questions",
    "symbols",
)
# An insult counts as near when a word of the second person is at most so many words away.
NEAR_WORDS = 5

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LETTER = _ALNUM.copy()
_LETTER[0x30:0x3A] = False
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_MASK = np.zeros(256, dtype=bool)
_MASK[[ord(c) for c in "*#@$%&_-."]] = True
# Digits and symbols written for the letters they look like.
_LOOKS = np.arange(256, dtype=np.uint8)
_LOOKS[0x41:0x5B] += 0x20
for _sign, _letter in zip("013457@$!|+", "oieastasiit", strict=True):
    _LOOKS[ord(_sign)] = ord(_letter)
_DRAWN = _ALNUM.copy()
_DRAWN[[ord(c) for c in "@$!|+"]] = True


def _trimmed(data: np.ndarray, words: Words, core: np.ndarray) -> Words:
    """The words without what stands before their first and behind their last byte of `core`."""
    at = np.arange(len(data))
    inside = core[data]
    after = np.minimum.accumulate(np.where(inside, at, len(data))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(inside, at, -1))
    starts = np.minimum(after[words.starts], words.ends) if len(words.starts) else words.starts
    ends = np.maximum(before[words.ends - 1] + 1, starts) if len(words.starts) else words.ends
    return Words(starts, ends, words.offsets)


def _plain_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    return word_hashes(lower_ascii(data), _trimmed(data, words, _ALNUM))


def _drawn_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """Hashes of the words as they look: signs as letters, doubled letters once, no masks inside."""
    spans = _trimmed(data, words, _DRAWN)
    looks = _LOOKS[data]
    keep = _DRAWN[data]
    keep[1:] &= ~((looks[1:] == looks[:-1]) & keep[:-1])
    keep[spans.starts[spans.starts < len(data)]] = True  # a word begins anew
    place = np.concatenate(([0], np.cumsum(keep)))
    return word_hashes(looks[keep], Words(place[spans.starts], place[spans.ends], spans.offsets))


def _known(words: Iterable[str], drawn: bool = False) -> np.ndarray:
    parts = [w.encode() for w in words]
    ends = np.cumsum([len(p) + 1 for p in parts])
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    spans = Words(np.concatenate(([0], ends[:-1])), ends - 1, np.array([0, len(parts)]))
    return np.unique((_drawn_hashes if drawn else _plain_hashes)(data, spans))


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


_INSULTS, _DRAWN_INSULTS, _PERSONS = _known(INSULTS), _known(INSULTS, drawn=True), _known(SECOND_PERSON)


def _nearest(at: np.ndarray, others: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Distance from each word number to the nearest of `others` in the same text."""
    far = np.full(len(at), np.iinfo(np.int64).max)
    if not len(others):
        return far
    place = np.searchsorted(others, at)
    for k in (place - 1, place):
        other = others[np.clip(k, 0, len(others) - 1)]
        same = (k >= 0) & (k < len(others)) & (owner[other] == owner[at])
        far = np.where(same, np.minimum(far, np.abs(other - at)), far)
    return far


def measure(texts: Texts, lexicon: np.ndarray) -> np.ndarray:
    """One row of `MEASURES` per text; an empty text has zeros. `lexicon` has sorted hashes of words."""
    data, offsets = texts.data, texts.offsets
    n = len(offsets) - 1
    words = find_words(data, offsets)
    count = np.diff(words.offsets)
    owner = np.repeat(np.arange(n), count)
    hashes = _plain_hashes(data, words)
    insult, person = _among(hashes, _INSULTS), _among(hashes, _PERSONS)
    hidden = _among(_drawn_hashes(data, words), _DRAWN_INSULTS) & ~insult
    learnt = _among(hashes, lexicon)
    hits = np.flatnonzero(insult | hidden | learnt)
    close = hits[_nearest(hits, np.flatnonzero(person), owner) <= NEAR_WORDS]

    spans = _trimmed(data, words, _LETTER)
    letter, upper = _LETTER[data], _UPPER[data]
    total = np.concatenate(([0], np.cumsum(_MASK[data])))
    masked = (total[spans.ends] - total[spans.starts]) > 0
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & letter[2:]
    total = np.concatenate(([0], np.cumsum(same)))
    stretched = (total[words.ends] - total[np.minimum(words.starts + 2, words.ends)]) > 0
    total = np.concatenate(([0], np.cumsum(upper)))
    length = spans.ends - spans.starts
    loud = (length > 1) & (total[spans.ends] - total[spans.starts] == length)
    single = length == 1
    spaced = np.zeros(len(single), bool)
    if len(single) > 3:  # four letters in a row that stand alone
        spaced[3:] = single[3:] & single[2:-1] & single[1:-2] & single[:-3] & (owner[3:] == owner[:-3])

    def kinds(flags: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(flags)
        again, _ = ranked(hashes[at], owner[at])
        return np.bincount(owner[at[~again]], minlength=n)

    def per_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, n) / np.maximum(count, 1)

    insults = np.bincount(owner, insult | hidden, n)
    toxic = np.bincount(owner, learnt, n)
    near = np.bincount(owner[close], minlength=n)
    hid = np.bincount(owner, hidden, n)
    size = np.maximum(np.diff(offsets), 1)
    columns = [
        np.log1p(count),
        insults / np.maximum(count, 1),
        np.log1p(insults),
        np.log1p(kinds(insult | hidden)),
        toxic / np.maximum(count, 1),
        np.log1p(toxic),
        np.log1p(kinds(learnt)),
        near / np.maximum(count, 1),
        near / np.maximum(np.bincount(owner[hits], minlength=n), 1),
        per_word(person),
        hid / np.maximum(count, 1),
        np.log1p(hid),
        per_word(masked),
        per_word(spaced),
        per_word(stretched),
        per_text(upper, offsets) / np.maximum(per_text(letter, offsets), 1),
        per_word(loud),
        per_text(data == ord("!"), offsets) / size,
        per_text(data == ord("?"), offsets) / size,
        per_text(_MASK[data], offsets) / size,
    ]
    return np.stack(columns, 1)


def measured(docs: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """`doc_id, measures` per row of `docs(doc_id, text, ...)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            rows = measure(texts, lexicon)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [texts.rows.column("doc_id"), pa.ListArray.from_arrays(offsets, rows.ravel())],
                names=["doc_id", "measures"],
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, measures array<double>")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a row without id counts as 1, so nothing is learnt from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3, F.lit(1))


def known_labels(labels: DataFrame) -> DataFrame:
    """`doc_id, label` of the ids that may be learnt from, written. Several labels of an id are
    averaged, null ones are left out."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(remainder(F.col("doc_id")) != 1)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("toxic") >= 0.5).cast("double").alias("label"))
    )
    return materialize(known, "toxic-labels")


def _drawn(doc_id: Column, most: int, there: int) -> Column:
    """Whether an id is among about `most` of `there`, by its hash."""
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << 30)) < int(min(1.0, most / max(there, 1)) * (1 << 30))


def learn_lexicon(docs: DataFrame, known: DataFrame, rows: int = 12_000, words: int = 5_000) -> np.ndarray:
    """Hashes of the words that toxic documents have far more often than others, sorted.

    Counts in how many texts of about `rows` labelled ids a word stands; texts whose smallest hash of
    five words in a row is the same are copies and count once. A word is toxic if most texts with it
    are, and the log-likelihood ratio of its two counts is 25 or more; the `words` most telling
    ones are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            spans = find_words(texts.data, texts.offsets)
            hashes = _plain_hashes(texts.data, spans)
            runs, bounds = window_hashes(hashes, spans.offsets, 5)
            n = len(texts.offsets) - 1
            sketch = np.array([runs[a:b].min() if b > a else 0 for a, b in zip(bounds, bounds[1:])], np.uint64)
            sets = [np.unique(hashes[a:b]) for a, b in zip(spans.offsets, spans.offsets[1:])]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [texts.rows.column("doc_id"), pa.array(sketch[:n].view(np.int64)), pa.ListArray.from_arrays(ends, flat)],
                names=["doc_id", "sketch", "words"],
            )

    there = known.count()
    chosen = known.where(_drawn(F.col("doc_id"), rows, there))
    ids = F.col("doc_id").cast("long")
    wanted = docs.where((remainder(ids) != 1) & _drawn(ids, rows, there)).select(ids.alias("doc_id"), "text")
    sets = wanted.mapInArrow(run, "doc_id long, sketch long, words array<long>").join(chosen, "doc_id")
    sets = sets.groupBy("sketch", "label").agg(F.max_by("words", "doc_id").alias("words"))
    sets = materialize(sets, "toxic-words")
    total = {r["label"]: r["count"] for r in sets.groupBy("label").count().collect()}
    a, b = total.get(1.0, 0), total.get(0.0, 0)
    if not a or not b:
        return np.zeros(0, np.uint64)
    counts = (
        sets.select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.count("*").alias("texts"))
        .where("2 * toxic > texts")
    )
    clean = F.col("texts") - F.col("toxic")
    expected = [F.col("texts") * (share / (a + b)) for share in (a, b)]
    parts = [F.when(n > 0, n * F.log(n / e)).otherwise(0.0) for n, e in zip((F.col("toxic"), clean), expected)]
    found = counts.withColumn("ratio", 2 * (parts[0] + parts[1])).where("ratio >= 25")
    best = found.orderBy(F.desc("ratio"), "word").limit(words).select("word").collect()
    return np.sort(np.array([r["word"] for r in best], np.int64).view(np.uint64))


def _logit(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """`rows` with `raw`, the log-odds of the trees."""
    scored = model.transform(rows.withColumn("features", array_to_vector("measures")))
    raw = vector_to_array("rawPrediction")[1].alias("raw")
    return scored.select(*rows.columns, raw)


class ToxicityModel:
    """Trees and their calibration, or one share for all rows where nothing could be learnt."""

    def __init__(
        self, share: float, trees: GBTClassificationModel | None = None, steps: IsotonicRegressionModel | None = None
    ) -> None:
        self.share, self.trees, self.steps = share, trees, steps

    def score(self, rows: DataFrame) -> DataFrame:
        """`rows(..., measures)` with `score`, the probability of label 1, in place of the measures."""
        kept = [c for c in rows.columns if c != "measures"]
        if self.trees is None or self.steps is None:
            return rows.select(*kept, F.lit(self.share).alias("score"))
        calibrated = self.steps.transform(_logit(self.trees, rows))
        return calibrated.select(*kept, F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))


def train(
    rows: DataFrame, known: DataFrame, train_rows: int = 60_000, trees: int = 20, depth: int = 3
) -> ToxicityModel:
    """A model of the labels of the written tables `rows(doc_id, measures)` and `known(doc_id, label)`.

    Of more than `train_rows` labelled ids about that many are taken, by hash. Three quarters (by
    another hash) grow the trees, the last one calibrates them; where it lacks a class, all rows
    calibrate. Without rows, or with one class, all scores are the share of label 1, kept off 0 and 1.
    """
    known = known.where(_drawn(F.col("doc_id"), train_rows, known.count()))
    sample = rows.join(known, "doc_id").withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)))
    sample = materialize(sample.select("label", "fold", "measures"), "toxic-sample")
    counts = {(r["calibrates"], r["label"]): r["count"] for r in sample.groupBy((F.col("fold") == 0).alias("calibrates"), "label").count().collect()}
    total = sum(counts.values())
    toxic = sum(v for (_, label), v in counts.items() if label == 1)
    share = (toxic + 1) / (total + 2)
    if len([k for k in counts if not k[0]]) < 2:
        return ToxicityModel(share)
    growing = sample.where("fold <> 0").withColumn("features", array_to_vector("measures")).select("label", "features")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=5, maxBins=256, seed=7).fit(growing)
    calibrating = sample.where("fold = 0") if len([k for k in counts if k[0]]) == 2 else sample
    pairs = materialize(_logit(model, calibrating).select("label", "raw"), "toxic-raw")
    return ToxicityModel(share, model, IsotonicRegression(featuresCol="raw").fit(pairs))


def score_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = 60_000) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of `docs(doc_id, text, ...)`.

    The score is the calibrated probability that `labels` calls the whole text toxic; predicted is 1
    from 0.7 up. Rows with null or empty text are scored as empty ones, repeated rows each, rows
    without id keep their null id. Columns besides `doc_id` and `text` are not read. Without usable
    labels all rows get one score; an empty table gives no rows.
    """
    known = known_labels(labels)
    rows = materialize(measured(docs, learn_lexicon(docs, known)), "toxic-measures")
    scored = train(rows, known, train_rows).score(rows)
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
