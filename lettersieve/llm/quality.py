"""Quality rules whose thresholds are chosen under a bound on false rejections.

Base counts of a text decide ``base_failed``. Beyond them, a few signals of a text may reject
it, each with a cutoff per stratum that is chosen on labelled holdout documents:

* lowering one cutoff of one signal by one grid step makes a rule that rejects a little more. Per stratum these
  steps are put into one order, *before any good document is looked at*: by how many bad labelled documents a step
  rejects for each unlabelled one. Only steps that reject the bad more often than the unlabelled are in it;
* the rules along this order reject nested sets. Each rule as a whole is tested on the good labelled documents: the
  exact (Clopper-Pearson) upper bound of its rate of false rejections must not exceed ALPHA. Testing in a fixed
  order and stopping at the first failure tests the whole family over signals and cutoffs at one level, so nothing
  of the level is spent on tests that are not reached;
* the last rule that passes is taken. The level is split evenly over the strata (Bonferroni), so with probability
  1 - DELTA no stratum loses more than ALPHA of its good documents to all cutoffs together;
* a stratum without enough labels to pass the first test gets no cutoff: nothing is rejected. With no false rejection
  at all that takes log(strata / DELTA) / -log(1 - ALPHA) good labels, about 230 for five strata.

What is counted is bounded per stratum (signals times grid steps). Strata are worked on apart, in groups of a Spark
job, so their number may be anything; no table of strata comes to the driver or is broadcast by this module.

Defined results: a null or empty text has zero counts and fails the base rule (under 50
words). Documents without label are judged, not counted. A null stratum is a stratum of its
own. Labels are joined by id after taking, per id, the highest quality, so repeated labels
count once. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.llm.common import ships_its_code
from lettersieve.sources.shared import stored

ships_its_code(__name__)

ALPHA = 0.02
DELTA = 0.05
MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
# Fixed grid: steps of a hundredth from the most lenient cutoff down. Signals lie in [0, 1].
GRID = 100
SIGNALS = ("symbols", "dup_lines", "repeats", "capitals", "long_words")

_NOT_SYMBOL = bytes(sorted(set(range(256)) - set(b"#*$%&|<>")))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_lines")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # Windows get dense numbers link by link, so equal numbers mean equal words.
    code = ids[:n]
    for k in range(1, window):
        _, code = np.unique(code * len(numbers) + ids[k : k + n], return_inverse=True)
    again = np.flatnonzero(np.bincount(code)[code] > 1)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``_COUNTS``."""
    data = (text or "").encode()
    words = data.split()
    # Code points: bytes that do not continue a character.
    solid = b"".join(words)
    raw = np.frombuffer(solid, dtype=np.uint8)
    chars = int(np.count_nonzero((raw & 0xC0) != 0x80))
    symbols = len(data.translate(None, _NOT_SYMBOL))
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeats = len(lines) - len(set(lines))
    upper = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
    lower = int(np.count_nonzero((raw >= 97) & (raw <= 122)))
    return len(words), chars, symbols, repeats, repeated_words(words), upper, lower, len(lines)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str | None = None) -> DataFrame:
    """(doc_id, stratum, counts) of each row."""
    which = F.col(stratum).cast("string") if stratum else F.lit(None).cast("string")
    chosen = docs.select(F.col(doc_id).alias("doc_id"), which.alias("stratum"), F.col(text).alias("text"))
    columns = ["doc_id", "stratum", *_COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array([x[i] for x in found], pa.int64()) for i in range(len(_COUNTS))],
                names=columns,
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, stratum string, " + ", ".join(f"{c} bigint" for c in _COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def signals() -> dict[str, Column]:
    """Signals in [0, 1]; high values speak against a text."""

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.least(part / whole, F.lit(1.0))).otherwise(F.lit(0.0))

    mean = F.when(F.col("n_words") > 0, F.col("word_chars") / F.col("n_words")).otherwise(F.lit(0.0))
    return {
        # Symbols are compared with words: 1 means a symbol for every second word and more.
        "symbols": share(2.0 * F.col("n_symbols"), F.col("n_words")),
        "dup_lines": share(F.col("n_dup_lines").cast("double"), F.col("n_lines")),
        "repeats": share(F.col("n_repeat_words").cast("double"), F.col("n_words")),
        "capitals": share(F.col("n_upper").cast("double"), F.col("n_upper") + F.col("n_lower")),
        "long_words": F.least(F.greatest((mean - 5.0) / 15.0, F.lit(0.0)), F.lit(1.0)),
    }


def level(signal: Column) -> Column:
    """The grid step of a signal: step g holds values from g / GRID on; 0 is never rejected."""
    return F.floor(signal * GRID + F.lit(1e-9)).cast("int")


def at_most(k: int, n: int, p: float) -> float:
    """The probability of k or fewer of n at rate p: an incomplete beta function, by its continued fraction."""
    if k >= n or p <= 0.0:
        return 1.0
    if k < 0 or p >= 1.0:
        return 0.0
    a, b, x = n - k, k + 1, 1.0 - p
    flip = x > (a + 1) / (a + b + 2)
    if flip:
        a, b, x = b, a, p
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    # Numerators of the fraction 1 + d1 / (1 + d2 / (1 + ...)), by the modified Lentz method.
    value, top, low, tiny = 1.0, 1.0, 0.0, 1e-300
    for i in range(1, 100_000):
        m = i // 2
        if i % 2:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        low = 1.0 / ((1.0 + d * low) or tiny)
        top = (1.0 + d / top) or tiny
        value *= top * low
        if abs(top * low - 1.0) < 1e-14:
            break
    found = scale / value
    return 1.0 - found if flip else found


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the largest rate under which k or fewer of n still has probability delta."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if at_most(k, n, middle) > delta else (low, middle)
    return high


def ordered_steps(bad: Mapping[tuple[str, int], int], others: Mapping[tuple[str, int], int]) -> list[tuple[str, int]]:
    """The (signal, grid step) in the order in which cutoffs are lowered, from counts by signal and step.

    A signal's steps come from the most lenient one down. Successive steps are joined to a block while that raises
    the block's share of the bad over its share of the others; blocks of all signals are then merged by this ratio.
    Steps without documents weigh a hundredth of a document on both sides.
    """
    blocks: list[tuple[float, str, list[int]]] = []
    for name in SIGNALS:
        m = max(1, sum(n for (signal, _), n in bad.items() if signal == name))
        u = max(1, sum(n for (signal, _), n in others.items() if signal == name))
        own: list[list] = []
        for g in range(GRID, 0, -1):
            own.append([(bad.get((name, g), 0) + 1 / GRID) / m, (others.get((name, g), 0) + 1 / GRID) / u, [g]])
            while len(own) > 1 and own[-1][0] * own[-2][1] > own[-2][0] * own[-1][1]:
                b, c, steps = own.pop()
                own[-1] = [own[-1][0] + b, own[-1][1] + c, own[-1][2] + steps]
        # With fewer of one kind the weights of empty steps differ, so a block has to hold bad documents.
        blocks += [
            (b / c, name, steps) for b, c, steps in own if b > c and any(bad.get((name, g), 0) for g in steps)
        ]
    merged = sorted(blocks, key=lambda block: -block[0])
    return [(name, g) for _, name, steps in merged for g in steps]


def last_passing(good: Counter[int], n: int, alpha: float, delta: float) -> tuple[int, int]:
    """(rank of the last rule that passes or -1, its false rejections): ``good`` counts n documents by the rank of
    the first rule that rejects them; those never rejected need not be in it."""
    if n == 0 or at_most(0, n, alpha) > delta:
        return -1, 0
    rejected = 0
    for rank in sorted(good):
        if at_most(rejected + good[rank], n, alpha) > delta:
            return rank - 1, rejected
        rejected += good[rank]
    return GRID * len(SIGNALS), rejected


def levels() -> dict[str, Column]:
    """The grid steps of all signals."""
    return {name: level(signal) for name, signal in signals().items()}


_STEPS = "stratum string, signal string, step int, place int"
_CHOSEN = "stratum string, signal string, cutoff int, n bigint, rejected bigint, bound double"


def _steps_of_stratum(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
    def table(kind: str) -> dict[tuple[str, int], int]:
        own = counts[counts["kind"] == kind]
        return dict(zip(zip(own["signal"], own["step"]), own["n"]))

    order = ordered_steps(table("bad"), table("other"))
    rows = [(key[0], signal, step, place) for place, (signal, step) in enumerate(order)]
    return pd.DataFrame(rows, columns=["stratum", "signal", "step", "place"])


def thresholds(features: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, signal, cutoff, n, rejected, bound): the cutoffs of the rule that each stratum takes.

    ``n``, ``rejected`` and ``bound`` are those of the whole rule and the same in all its rows. Documents without
    label stand for the corpus in the order of steps, good ones are only tested.
    """
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality in (0, 1)")
    steps = F.array(*[F.struct(F.lit(k).alias("signal"), s.alias("step")) for k, s in levels().items()])
    kind = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad").otherwise("other")
    rows = features.filter(~base_failed()).join(known, "doc_id", "left").select("stratum", kind.alias("kind"), steps.alias("steps"))
    # One row per stratum, kind and combination of steps that occurs: combinations are few against documents.
    seen = stored(rows.groupBy("stratum", "kind", "steps").agg(F.count("*").alias("n")), "quality-steps")
    single = seen.filter("kind != 'good'").select("stratum", "kind", "n", F.inline("steps"))
    order = stored(
        single.groupBy("stratum", "kind", "signal", "step")
        .agg(F.sum("n").alias("n"))
        .groupBy("stratum")
        .applyInPandas(_steps_of_stratum, _STEPS),
        "quality-order",
    )
    strata = max(1, seen.select("stratum").distinct().count())
    good = seen.filter("kind = 'good'")
    # The first rule that rejects a combination is the first one that comes to one of its steps.
    reached = (
        good.select("stratum", "steps", "n", F.explode("steps").alias("x"))
        .alias("g")
        .join(
            order.alias("o"),
            F.col("g.stratum").eqNullSafe(F.col("o.stratum")) & (F.col("x.signal") == F.col("o.signal")) & (F.col("x.step") == F.col("o.step")),
            "left",
        )
        .groupBy("g.stratum", "g.steps", "g.n")
        .agg(F.min("place").alias("place"))
        .groupBy("stratum", "place")
        .agg(F.sum("n").alias("n"))
    )

    def chosen(key: tuple, own: pd.DataFrame, places: pd.DataFrame) -> pd.DataFrame:
        counted = Counter({int(p): int(n) for p, n in zip(own["place"], own["n"]) if not pd.isna(p)})
        n = int(own["n"].sum())
        last, rejected = last_passing(counted, n, alpha, delta / strata)
        cutoffs = places[places["place"] <= last].groupby("signal")["step"].min()
        bound = upper_bound(rejected, n, delta / strata) if len(cutoffs) else 1.0
        rows = [(key[0], signal, int(step), n, rejected, bound) for signal, step in cutoffs.items()]
        return pd.DataFrame(rows, columns=["stratum", "signal", "cutoff", "n", "rejected", "bound"])

    return reached.groupBy("stratum").cogroup(order.groupBy("stratum")).applyInPandas(chosen, _CHOSEN)


def judged(features: DataFrame, chosen: DataFrame) -> DataFrame:
    """``features`` with base_failed, reasons (signals beyond their cutoff) and kept."""
    wide = chosen.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("signal", "cutoff"))).alias("cutoffs")
    )
    # A stored table: Spark broadcasts it by its size, or else shuffles and splits a stratum that is most rows.
    joined = features.alias("f").join(
        stored(wide, "quality-cutoffs").alias("w"), F.col("f.stratum").eqNullSafe(F.col("w.stratum")), "left"
    )
    reasons = F.array_compact(
        F.array(*[F.when(step >= F.col("cutoffs")[k], F.lit(k)) for k, step in levels().items()])
    )
    return (
        joined.select("f.*", "cutoffs")
        .withColumn("base_failed", base_failed())
        .withColumn("reasons", reasons)
        .withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0))
        .drop("cutoffs")
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: counts, base_failed, kept and the reasons, with cutoffs per language."""
    features = stored(measured(docs, stratum="lang"), "quality-counts")
    rows = judged(features, thresholds(features, labels))
    return rows.select(
        "doc_id",
        *_COUNTS[:5],
        "base_failed",
        "kept",
        F.array_join("reasons", ",").alias("reasons"),
    )
