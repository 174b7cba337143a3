"""Users who together reach most others."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admesh.storage import RunFolder

BUCKET = ["item_id", "month"]
BATCH = 128  # candidates whose gain is counted together


def cover_users(candidates: DataFrame, incidence: DataFrame, run: RunFolder, k: int = 20, batch: int = BATCH) -> DataFrame:
    """``rank, id, gain, reached``: greedily, the candidate who reaches most users not yet reached, lower id first, k times.

    A user reaches itself and its co-buyers; ``gain`` counts those that no
    earlier pick reaches, ``reached`` all so far. The result is within 1 - 1/e of
    the best k users.

    Gains only shrink as picks are added, so a gain of an earlier round bounds
    today's (Minoux's lazy greedy). The first bound is the degree, which counts a
    co-buyer once per shared bucket. Candidates are counted anew in the order of
    their bounds, ``batch`` at a time, until the best of all has a gain of this
    round. Counting lists the co-buyers of these few candidates only; the driver
    sees a batch of ids and the picks. All candidates are eligible: the batch is
    a step, not a limit.
    """
    placed = run.write(incidence.select("id", *BUCKET), "placed")
    degrees = incidence.groupBy("id").agg(F.sum("others").alias("degree"))
    first = run.write(
        candidates.select("id").distinct().join(degrees, "id", "left")
        .select("id", (F.coalesce("degree", F.lit(0)) + 1).alias("bound"), F.lit(0).alias("round")), "bounds")
    spark = first.sparkSession
    counted, covered, picks, reached = None, None, [], 0

    def members(ids: list[int]) -> DataFrame:
        """``candidate, id`` for each user that some candidates reach and no pick does."""
        some = spark.createDataFrame([(i,) for i in ids], "candidate bigint")
        own = placed.join(some, placed["id"] == some["candidate"]).select("candidate", *BUCKET)
        met = own.join(placed, BUCKET).select("candidate", "id").union(some.select("candidate", F.col("candidate").alias("id")))
        return met.distinct() if covered is None else met.distinct().join(covered, "id", "left_anti")

    while len(picks) < k:
        now = len(picks) + 1
        known = first if counted is None else first.join(counted, "id", "left_anti").unionByName(counted)
        front = known.filter(~F.col("id").isin([p[1] for p in picks])).orderBy(F.desc("bound"), "id").limit(batch + 1).collect()
        stale = [r.id for r in front[:batch] if r["round"] != now]
        if stale and front[0]["round"] != now:
            gains = members(stale).groupBy(F.col("candidate").alias("id")).agg(F.count(F.lit(1)).alias("bound"))
            asked = spark.createDataFrame([(i,) for i in stale], "id bigint").join(gains, "id", "left").select(
                "id", F.coalesce("bound", F.lit(0).cast("bigint")).alias("gain"))
            old = first.limit(0) if counted is None else counted
            counted = run.write(
                old.join(asked, "id", "full").select(
                    "id", F.coalesce("gain", "bound").alias("bound"),
                    F.when(F.col("gain").isNotNull(), now).otherwise(F.col("round")).alias("round")), "counted")
            here = counted.filter(F.col("round") == now).orderBy(F.desc("bound"), "id").limit(1).collect()
            beyond = front[batch:]  # the best that was not counted, if any
            front = here if not beyond or (-here[0].bound, here[0].id) < (-beyond[0].bound, beyond[0].id) else []
            if not front:
                continue
        if not front or front[0].bound <= 0:  # everyone in reach is reached
            break
        best = front[0]
        new = members([best.id]).select("id")
        reached += best.bound
        picks.append((now, best.id, best.bound, reached))
        covered = run.write(new if covered is None else covered.union(new), "covered")
    return spark.createDataFrame(picks, "rank bigint, id bigint, gain bigint, reached bigint")
