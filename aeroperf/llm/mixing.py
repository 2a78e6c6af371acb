"""Mixing sources to target weights: temperature, then budgeted block permutations.

Each source's share of tokens is raised to an exponent and normalised: 1 keeps
the shares, 0 makes them equal. The exponent is found by bisection, as the
largest change towards equal weights under which no source is repeated more
than ``max_epochs`` times, or as the one that meets a target entropy. The
weights are realised as blocks: a block is one permutation of a source, and a
source whose budget is 2.4 times its tokens gets two whole blocks and the
documents of a third until the budget is used up.

Tokens are counted in one pass, which leaves a narrow row for each document:
source, hash, tokens. A document's place in a block is a hash of that hash, so a
budget ends at a place: sums by slots of places find the slot, and only the
narrow rows of that one slot are put in order. Slots are as many as keep them
small, whatever the size of a source. Texts are read once more, and each
document's blocks follow from its hash and its source's line in a broadcast
table: no text is shuffled, and no source, however hot, meets in one task.
"""

from __future__ import annotations

import math

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroperf.llm.columns import fresh
from aeroperf.llm.hashing import slices
from aeroperf.llm.storage import stored
from aeroperf.llm.tokens import encoder
from aeroperf.llm.workers import tidy


def n_words(text: Column) -> Column:
    """Words of a text between white space (space, tab to carriage return); 0 for null or blank."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+", "w")
    return F.length(F.regexp_replace(trimmed, "[\\x20\\x09-\\x0D]+", "")).cast("long")


def temper(tokens: dict, exponent: float) -> dict:
    """Normalised weights of the sources' token shares raised to ``exponent``; a source without tokens weighs 0."""
    total = sum(tokens.values())
    raised = {s: (n / total) ** exponent if n else 0.0 for s, n in tokens.items()}
    norm = sum(raised.values())
    return {s: x / norm for s, x in raised.items()}


def entropy(weights: dict) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w)


def spread(tokens: dict, exponent: float) -> float:
    """Epochs of the most repeated source, for each epoch of the least repeated one."""
    w = temper(tokens, exponent)
    epochs = [w[s] / n for s, n in tokens.items() if n]
    return max(epochs) / min(epochs)


def bisect_exponent(tokens: dict, max_epochs: float | None = 1.25, target_entropy: float | None = None, steps: int = 60) -> float:
    """The exponent in 0..1 that meets the target; the nearer end where none does.

    ``target_entropy`` (in nats) wins over ``max_epochs`` when both are given.
    Both measures are monotone in the exponent.
    """
    tokens = {s: n for s, n in tokens.items() if n}
    if len(tokens) < 2:
        return 1.0
    far = (lambda e: entropy(temper(tokens, e)) < target_entropy) if target_entropy is not None else (lambda e: spread(tokens, e) <= max_epochs)
    # far(e): e is too near to 1 (entropy), or 1 side is still within the limit (epochs)
    low, high = 0.0, 1.0
    if target_entropy is not None:
        if not far(1.0):
            return 1.0
        if far(0.0):
            return 0.0
        for _ in range(steps):
            mid = (low + high) / 2
            low, high = (low, mid) if far(mid) else (mid, high)
        return low
    if far(0.0):
        return 0.0
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if far(mid) else (mid, high)
    return high


def token_counts(rows: DataFrame, tokenizer: str | None) -> DataFrame:
    """source, h, tokens of rows (source, h, text): ids of whole texts under a vocabulary file, or words where there is none."""
    if tokenizer is None:
        return rows.select("source", "h", n_words(F.col("text")).alias("tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for part in (p for b in batches for p in slices(b, "text")):
            _, starts = encode(part.column("text"), None)
            yield pa.RecordBatch.from_arrays([part.column("source"), part.column("h"), pa.array(np.diff(starts))], ["source", "h", "tokens"])

    return rows.mapInArrow(tidy(run), f"source {dict(rows.dtypes)['source']}, h long, tokens long")


def source_sizes(counted: DataFrame, max_sources: int = 1_000_000) -> dict:
    """{source: (tokens, rows)} over all rows, at the driver: one row per source; more than ``max_sources`` raise ValueError."""
    sums = counted.groupBy("source").agg(F.sum("tokens"), F.count("*")).limit(max_sources + 1).collect()
    if len(sums) > max_sources:
        raise ValueError(f"more than {max_sources} sources: a table of weights that is broadcast must stay small")
    return {r[0]: (int(r[1] or 0), int(r[2])) for r in sums}


def mix(
    docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", source: str = "source", text: str = "text", max_epochs: float | None = 1.25, target_entropy: float | None = None,
    budget: int | None = None, seed: int = 17, slot_rows: int = 1 << 16, names: tuple[str, str, str] = ("epoch", "mix_weight", "mix_order"),
) -> DataFrame:
    """Rows of ``docs``, as often as the mixture takes them, with epoch (from 0), mix_weight and mix_order (a uniform hash to sort by), or other ``names``.

    Tokens are the ids of whole texts under the vocabulary file ``tokenizer``;
    without one, words. ``budget`` is the total to realise; by default the least
    under which every source comes at least once in whole, so that no document
    is lost, and the most repeated source ``max_epochs`` times. The block in
    which a budget ends takes documents in the block's order while they begin
    within the budget, so a source passes its budget by less than one document.
    A null source is a source of its own. Documents without tokens come with
    every block that they begin in. Repeated rows (same id and text) have the
    same place and come in any order. An empty table gives an empty one. Older
    columns of ``names`` are replaced.
    """
    spark = docs.sparkSession
    base = docs.drop(*names)
    h = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text))
    counted = stored(token_counts(base.select(F.col(source).alias("source"), h.alias("h"), F.col(text).alias("text")), tokenizer), "token-counts")
    sizes = source_sizes(counted)
    tokens = {s: n for s, (n, _) in sizes.items()}
    weights = temper(tokens, bisect_exponent(tokens, max_epochs, target_entropy)) if any(tokens.values()) else {s: 0.0 for s in tokens}
    if budget is None:
        budget = max((tokens[s] / w for s, w in weights.items() if w), default=0)
    blocks = {}  # whole blocks of each source, and tokens of one more
    for s, n in tokens.items():
        want = round(weights[s] * budget, 6)
        whole = int(want // n) if n else 1
        rest = want - whole * n if n else 0.0
        blocks[s] = (whole + 1, 0.0) if n and n - rest < 1e-3 else (whole, rest)
    kind = dict(docs.dtypes)[source]
    slot_bits = max(0, math.ceil(math.log2(max((n for _, n in sizes.values()), default=1) / slot_rows)))
    ends = _ends(counted, blocks, kind, seed, slot_bits) if any(rest > 0 for _, rest in blocks.values()) else {}
    rows = [(s, weights[s], blocks[s][0], *ends.get(s, (None, None, None))) for s in tokens]
    of, key, weight, whole, end, at, within, last, epoch, number = fresh(base, *(f"_mix_{x}" for x in ("source", "hash", "weight", "whole", "end", "at", "in", "last", "epoch", "number")))
    plan = spark.createDataFrame(rows, f"{of} {kind}, {weight} double, {whole} int, {end} long, {at} long, {within} long")
    joined = base.withColumn(key, h).join(F.broadcast(plan), F.col(source).eqNullSafe(F.col(of)))  # source_sizes bounds it
    joined = joined.withColumn(last, _place(seed, F.col(whole), key))
    all_tied, at_end = F.col(at) == F.col(within), F.col(last) == F.col(end)
    takes_last = F.coalesce((F.col(last) < F.col(end)) | (at_end & all_tied), F.lit(False))
    count = F.col(whole) + takes_last.cast("int")
    epochs = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    columns = [*[F.col(f"`{c}`") for c in base.columns], F.col(epoch).alias(names[0]), F.col(weight).alias(names[1]), _place(seed, F.col(epoch), key).alias(names[2])]
    out = joined.withColumn(epoch, F.explode(epochs)).select(columns)
    if all(n == some for _, n, some in ends.values()):
        return out
    # repeated rows at the place where a budget ends, of which only some fit
    numbered = joined.where(at_end & ~all_tied).withColumn(number, F.row_number().over(Window.partitionBy(source).orderBy(last)))
    return out.unionByName(numbered.where(F.col(number) <= F.col(within)).withColumn(epoch, F.col(whole)).select(columns))


def _place(seed: int, epoch: Column, h: str) -> Column:
    return F.xxhash64(F.lit(seed), epoch, F.col(h))


def _ends(counted: DataFrame, blocks: dict, kind: str, seed: int, slot_bits: int) -> dict:
    """{source: (place of the last document of its last block, rows at that place, how many of them are within)}; one line a source."""
    spark = counted.sparkSession
    wanted = spark.createDataFrame([(s, whole, rest) for s, (whole, rest) in blocks.items() if rest > 0], f"_s {kind}, whole int, rest double")
    last = counted.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("_s"))).withColumn("place", _place(seed, F.col("whole"), "h"))
    last = last.withColumn("slot", F.shiftright("place", 64 - slot_bits) if slot_bits else F.lit(0).cast("long"))
    before = Window.partitionBy("_s").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = last.groupBy("_s", "rest", "slot").agg(F.sum("tokens").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    edges = stored(sums.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest"))).select(F.col("_s").alias("_edge"), F.col("slot").alias("_slot"), "before"), "edges")
    edge = last.join(F.broadcast(edges), F.col("_s").eqNullSafe(F.col("_edge")) & (F.col("slot") == F.col("_slot")))  # a line a source
    running = Window.partitionBy("_s").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    within = F.col("before") + F.coalesce(F.sum("tokens").over(running), F.lit(0)) < F.col("rest")
    places = edge.withColumn("within", within.cast("long")).groupBy("_s", "place").agg(F.count("*").alias("n"), F.sum("within").alias("within")).where("within > 0")
    return {r["_s"]: tuple(r["e"]) for r in places.groupBy("_s").agg(F.max(F.struct("place", "n", "within")).alias("e")).collect()}
