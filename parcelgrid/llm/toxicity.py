"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, toxic and ordinary, are counted on the labelled training
rows; an expression counts once per text, so a text that repeats itself weighs
no more than another. Both interpolate with absolute discounts, first with their
own counts of distinct contexts, then with the shared ones of both classes.
Every word and every bigram of the training rows is counted, however rare; a
bigram in fewer than ``LEAST`` texts is scored by its word, which is its backoff.
What the class models say of an expression, the difference of its
log-likelihoods, counts by its evidence: the weight rises with the likelihood
ratio statistic of its counts, is one half at ``EVIDENCE`` and never zero, and what
it leaves goes to the backoff, in the end to the shared counts, which are the
same on both sides and cancel out. (Without it the many words that one toxic text
has by chance outweigh the few that tell: ROC area 0.65 in place of 0.83 on held-out rows.) A text's value is the sum over its
number of tokens. Differences below ``RESOLUTION``, less than one bin of the scale
below in a text of 64 tokens, count as none.

The counts cover all training rows and grow with them. A rising
step curve (pooled adjacent violators) then turns the value into a probability.
It is fitted to a histogram of all training rows' values, which has at most
``2 * BINS`` rows at any size.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from parcelgrid.llm.scratch import Kept
from parcelgrid.llm.texts import slices

LETTERS = re.compile(r"[^\W\d_]+")
LEAST = 5
#: The statistic at which a difference counts by half, and how fast its weight rises about it: of five
#: pairs the best on the training rows of sf0.1, fitted on one half of them and judged on the other.
EVIDENCE, WIDTH = 10.0, 1.5
RESOLUTION = 1e-3
#: Labels and model entries are broadcast up to so many rows of 17 bytes; beyond, labels are joined, and of
#: the entries those seen most often are broadcast and the others joined.
BROADCAST_ROWS = 4_000_000
#: Of the others, 32 bits of each key are broadcast, so that only their own tokens are shuffled; beyond so
#: many of them all tokens are that no frequent entry has.
MARKS = 50_000_000
BINS = 1024
BIN_WIDTH = 1 / 64
THRESHOLD = 0.7
SALTS = 16


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words of letters, in order, and how many each text has."""
    ids: defaultdict[str, int] = defaultdict(count().__next__)
    parts, sizes = [np.zeros(0, np.int64)], []
    for text in texts:
        own = LETTERS.findall((text or "").lower())
        parts.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
        sizes.append(len(own))
    hashes = np.array([xxh64_intdigest(word.encode("utf-8", "surrogatepass")) for word in ids], np.uint64)
    flat = np.concatenate(parts)
    return hashes.view(np.int64)[flat] if len(flat) else flat, np.array(sizes, np.int64)


def contexts(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The low 32 bits of the word before each one; 0 for the first of a text."""
    before = np.zeros(len(words), np.int64)
    before[1:] = words[:-1] & 0xFFFFFFFF
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[starts] = 0
    return before


def bigram_key(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    return words ^ (before << 32) ^ before


def bigram_key_column() -> Column:
    return F.col("w").bitwiseXOR(F.shiftleft("u", 32)).bitwiseXOR(F.col("u"))


def once_per_text(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the first occurrence of each key in each text."""
    owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    # an odd multiplier spreads the texts over all 64 bits
    mixed = keys.view(np.uint64) + owner * np.uint64(0x9E3779B97F4A7C15)
    return np.unique(mixed, return_index=True)[1]


def summed(key: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the first row of each key, and its ordinary and toxic rows."""
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    both = np.bincount(inverse, minlength=len(first))
    bad = np.bincount(inverse[toxic], minlength=len(first))
    return first, both - bad, bad


def member(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in the sorted ones, and where."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys, at


def bigram_counts(train: DataFrame) -> DataFrame:
    """``w, u, o, t``: ordinary and toxic texts with word ``w`` after context ``u``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words, sizes = tokens(part.column("text").to_pylist())
            before = contexts(words, sizes)
            toxic = np.repeat(part.column("toxic").to_numpy() == 1, sizes)
            keep = once_per_text(bigram_key(words, before), sizes)
            words, before, toxic = words[keep], before[keep], toxic[keep]
            first, ordinary, bad = summed(bigram_key(words, before), toxic)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (words[first], before[first], ordinary, bad)], ["w", "u", "o", "t"]
            )

    rows = train.mapInArrow(find, "w long, u long, o long, t long")
    # salted by context, so that a very common word is spread, yet later sums by word stay small
    salted = rows.withColumn("s", F.col("u") % SALTS)
    return salted.groupBy("w", "s", "u").agg(F.sum("o").alias("o"), F.sum("t").alias("t")).drop("s")


def discount(ones: int | None, twos: int | None) -> float:
    """The absolute discount from the numbers of things seen once and twice."""
    return ones / (ones + 2 * twos) if ones and twos else 0.75


def ratio_statistic(bad: Column, good: Column, share: Column) -> Column:
    """2 * log likelihood ratio of the two counts against an expected toxic share."""
    n = bad + good
    part = lambda seen, expected: F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)
    return 2 * (part(bad, n * share) + part(good, n * (1 - share)))


def weight(statistic: Column) -> Column:
    return 1 / (1 + F.exp((EVIDENCE - statistic) / WIDTH))


def model(train: DataFrame) -> DataFrame:
    """``key, gain, bigram, extra, seen``: words (by hash) and bigrams (by key), and toxic minus ordinary log-likelihood by evidence.

    ``extra`` is the gain less what the word of a bigram has by itself, ``seen`` how many texts have the bigram,
    or the bigrams of the word. ``train`` has ``text, toxic``. Without rows of both classes nothing is told apart.
    """
    grams = Kept(bigram_counts(train), "bigrams").df
    seen = lambda c, n: F.count_if(F.col(c) == n).alias(f"{c}{n}")
    single = Kept(
        grams.groupBy("w").agg(
            F.count_if(F.col("o") > 0).alias("no"), F.count_if(F.col("t") > 0).alias("nt"), F.count("*").alias("ns"),
            seen("o", 1), seen("o", 2), seen("t", 1), seen("t", 2), F.sum(F.col("o") + F.col("t")).alias("seen"),
        ),
        "words",
    ).df
    sums = single.agg(
        *(F.sum(c).alias(c) for c in ("no", "nt", "ns", "o1", "o2", "t1", "t2")),
        *(F.count_if(F.col(c) > 0).alias(f"types_{c}") for c in ("no", "nt")),
        *(F.count_if(F.col(c) == k).alias(f"{c}_{k}") for c in ("no", "nt") for k in (1, 2)),
    ).first()
    if not sums["no"] or not sums["nt"]:
        return train.sparkSession.createDataFrame([], "key long, gain double, bigram boolean, extra double, seen long")

    def backed(c: str) -> Column:
        d = discount(sums[f"{c}_1"], sums[f"{c}_2"])
        own = F.greatest(F.col(c) - d, F.lit(0.0)) / sums[c]
        return own + d * sums[f"types_{c}"] / sums[c] * F.col("ns") / sums["ns"]

    share = F.lit(sums["nt"] / (sums["nt"] + sums["no"]))
    single = single.select("w", "no", "nt", backed("no").alias("po"), backed("nt").alias("pt"), "seen")
    by_word = weight(ratio_statistic(F.col("nt"), F.col("no"), share)) * F.ln(F.col("pt") / F.col("po"))
    single = single.select("w", "po", "pt", by_word.alias("gain"), "seen")
    told = F.abs("gain") >= RESOLUTION
    before = grams.groupBy("u").agg(
        F.sum("o").alias("uo"), F.sum("t").alias("ut"), F.count_if(F.col("o") > 0).alias("ko"), F.count_if(F.col("t") > 0).alias("kt")
    )
    both = grams.filter(F.col("o") + F.col("t") >= LEAST).join(single.drop("seen"), "w").join(before, "u")

    def full(c: str, d: float) -> Column:
        base, lower = F.col(f"u{c}"), F.col(f"p{c}")
        after = (F.greatest(F.col(c) - d, F.lit(0.0)) + d * F.col(f"k{c}") * lower) / base
        return F.when(base > 0, after).otherwise(lower)

    expected = F.col("ut") * F.col("pt") / (F.col("ut") * F.col("pt") + F.col("uo") * F.col("po"))
    inner = F.least(F.greatest(expected, F.lit(1e-9)), F.lit(1 - 1e-9))
    own = F.ln(full("t", discount(sums["t1"], sums["t2"])) / full("o", discount(sums["o1"], sums["o2"])))
    part = weight(ratio_statistic(F.col("t"), F.col("o"), inner))
    pairs = both.withColumn("paired", part * own + (1 - part) * F.col("gain"))
    pairs = pairs.filter(F.abs(F.col("paired") - F.col("gain")) >= RESOLUTION).select(
        bigram_key_column().alias("key"), F.col("paired").alias("gain"), F.lit(True).alias("bigram"),
        (F.col("paired") - F.when(told, F.col("gain")).otherwise(0.0)).alias("extra"), (F.col("o") + F.col("t")).alias("seen"),
    )
    alone = single.filter(told).select(F.col("w").alias("key"), "gain", F.lit(False).alias("bigram"), F.col("gain").alias("extra"), "seen")
    return pairs.unionByName(alone)


def gains(found: pa.Table, bigram: bool, column: str = "gain") -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their gains, of the bigrams or of the words."""
    own = found.filter(pc.equal(found["bigram"], bigram)).sort_by("key")
    return own["key"].to_numpy(), own[column].to_numpy()


def values(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """``id, value``: the mean gain of each text of ``id, text``; 0 without tokens."""
    entries = Kept(entries, "model").df
    schema = T.StructType([docs.schema["id"], T.StructField("value", T.DoubleType())])
    if entries.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return values_by_join(docs, entries)
    found = entries.select("key", "gain", "bigram").toArrow()
    tables = docs.sparkSession.sparkContext.broadcast([gains(found, kind) for kind in (False, True)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (word_keys, word_gains), (pair_keys, pair_gains) = tables.value
        for part in slices(batches, "text"):
            words, sizes = tokens(part.column("text").to_pylist())
            gain = np.zeros(len(words))
            for keys, own, of in (
                (words, word_gains, word_keys),
                (bigram_key(words, contexts(words, sizes)), pair_gains, pair_keys),
            ):
                known, at = member(of, keys)
                gain[known] = own[at[known]]
            owner = np.repeat(np.arange(len(sizes)), sizes)
            total = np.bincount(owner, gain, minlength=len(sizes))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(total / np.maximum(sizes, 1))], ["id", "value"]
            )

    return docs.mapInArrow(score, schema)


def often_seen(entries: DataFrame) -> Column:
    """Whether an entry is among the ``BROADCAST_ROWS`` seen most often, by eighths of a power of two."""
    step = F.floor(F.log2("seen") * 8)
    least, held = float("inf"), 0
    # a few hundred rows at most
    for row in entries.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        held += row["count"]
        if held > BROADCAST_ROWS:
            break
        least = row["step"]
    return step >= F.lit(least)


def marks_of(entries: DataFrame, bigram: bool) -> np.ndarray:
    """The low 32 bits of the keys of the bigrams or of the words, sorted."""
    own = entries.filter(F.col("bigram") == bigram).select(F.col("key").bitwiseAND(0xFFFFFFFF).alias("mark"))
    # as signed numbers of four bytes
    low = F.when(F.col("mark") >= 1 << 31, F.col("mark") - (1 << 32)).otherwise(F.col("mark")).cast("int")
    return np.unique(own.select(low.alias("mark")).toArrow()["mark"].to_numpy())


def counted(owner: np.ndarray, keys: np.ndarray, bigram: bool) -> tuple[np.ndarray, ...]:
    """The distinct (owner, key), by owner, with ``bigram`` and how often each is there."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])][: len(keys)])
    return owner[first], keys[first], np.full(len(first), bigram), np.diff(np.r_[first, len(keys)])


def values_by_join(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """The same where the model is too large to broadcast: a token has what its word and its bigram add.

    Entries seen often are broadcast and summed where the texts are. Tokens that may be one of the others
    meet them by key; there are few of them, and no text is written or shuffled.
    """
    often = often_seen(entries)
    others = entries.filter(~often).select("key", "bigram", "extra")
    found = entries.filter(often).select("key", "bigram", "extra").toArrow()
    few = others.limit(MARKS + 1).count() <= MARKS
    kinds = [(*gains(found, kind, "extra"), marks_of(others, kind) if few else None) for kind in (False, True)]
    tables = docs.sparkSession.sparkContext.broadcast(kinds)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words, sizes = tokens(part.column("text").to_pylist())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            known = np.zeros(len(sizes))
            rest = []
            for bigram, (of, own, marks) in zip((False, True), tables.value):
                keys = bigram_key(words, contexts(words, sizes)) if bigram else words
                told, at = member(of, keys)
                known += np.bincount(owner[told], own[at[told]], minlength=len(sizes))
                asked = ~told if marks is None else ~told & member(marks, keys.astype(np.int32))[0]
                rest.append(counted(owner[asked], keys[asked], bigram))
            of_text, *columns = (np.concatenate(c) for c in zip(*rest))
            order = np.argsort(of_text, kind="stable")
            ends = np.searchsorted(of_text[order], np.arange(len(sizes)), "right")
            each = pa.StructArray.from_arrays([pa.array(c[order]) for c in columns], ["key", "bigram", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("id"),
                    pa.array(known),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), each),
                ],
                ["row", "id", "known", "n", "asked"],
            )

    token = T.StructType().add("key", "long").add("bigram", "boolean").add("times", "long")
    schema = T.StructType().add("row", "long").add(docs.schema["id"]).add("known", "double").add("n", "long")
    schema = schema.add("asked", T.ArrayType(token))
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    # written with their numbers, which another run may give otherwise
    rows = Kept(rows.mapInArrow(find, schema), "sums").df
    each = rows.select("row", F.explode("asked").alias("token")).select("row", "token.*")
    sums = each.join(others, ["key", "bigram"]).groupBy("row").agg(F.sum(F.col("extra") * F.col("times")).alias("more"))
    total = F.col("known") + F.coalesce("more", F.lit(0.0))
    return rows.join(sums, "row", "left").select("id", (total / F.greatest("n", F.lit(1))).alias("value"))


def stretched(value: Column) -> Column:
    """The value on a scale that is even for one telling word in thousands and for many."""
    return F.signum(value) * F.log1p(1000 * F.abs(value))


def curve(bins: list[tuple[int, int, int]]) -> np.ndarray:
    """The probability of each bin from -BINS to BINS, given (bin, ordinary, toxic): rising steps.

    Neighbouring steps that fall are pooled. Each pool counts one more row that
    is toxic with the overall share, so few rows are never certain. Between two
    steps the curve is a straight line, and a slight slope keeps the order.
    """
    everywhere = np.arange(-BINS, BINS + 1)
    rows = sum(good + bad for _, good, bad in bins)
    if not rows:
        return np.full(len(everywhere), 0.5)
    share = sum(bad for _, _, bad in bins) / rows
    pools: list[list[float]] = []  # first bin, last bin, rows, toxic rows
    for at, good, bad in sorted(bins):
        pools.append([at, at, good + bad, bad])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, last, n, toxic = pools.pop()
            pools[-1][1:] = [last, pools[-1][2] + n, pools[-1][3] + toxic]
    x = [edge for first, last, _, _ in pools for edge in (first, last)]
    p = [(toxic + share) / (n + 1) for _, _, n, toxic in pools for _ in range(2)]
    steps = np.maximum.accumulate(np.interp(everywhere, x, p))
    return 0.999 * steps + 0.001 * (everywhere + BINS) / (2 * BINS)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``id, held_out, score, predicted``, one row per row of ``docs``.

    Rows whose CRC-32 of the id, as text, leaves 1 when divided by 3 are held
    out: their labels are not read. A null id is not held out and has no label;
    labels other than 0 and 1 are ignored, of several the highest counts. Null
    and empty texts have no tokens and have the value 0, and the score of the training rows around it. Without training rows every score is 0.5.
    Repeated rows repeat, an empty table gives no rows, other columns are not
    looked at.
    """
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    marks = (
        labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held)
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    marks = Kept(marks, "labels").df
    side = F.broadcast(marks) if marks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else marks
    train = texts.join(side, "id").select("text", "toxic")
    found = Kept(values(texts, model(train)), "values").df
    x = F.round(stretched(F.col("value")) / BIN_WIDTH)
    at = F.greatest(F.least(x, F.lit(BINS)), F.lit(-BINS)).cast("int").alias("bin")
    binned = found.select("id", at)
    histogram = binned.join(side, "id").groupBy("bin").agg(
        F.count_if(F.col("toxic") == 0).alias("good"), F.count_if(F.col("toxic") == 1).alias("bad")
    )
    fitted = curve([(r.bin, r.good, r.bad) for r in histogram.collect()]).tolist()
    # one row per bin
    scores = docs.sparkSession.createDataFrame(list(zip(range(-BINS, BINS + 1), fitted)), "bin int, score double")
    return binned.join(F.broadcast(scores), "bin").select(
        F.col("id").alias(id_col),
        held.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
