"""Numbers that change hands: claims of accounts for SSNs, judged as if they were made one by one.

A claim (``at``, ``SSN``, ``wanted``) asks that the account which began as ``SSN`` have the number ``wanted``. It succeeds if nobody else has the number at that point;
the account then gives up the one it had. Whether a claim succeeds thus depends on earlier ones, of its own account and of others."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeledger.plans.shared_folder import new_folder, passing_folder, written


def judged_claims(claims: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(``wanted``, ``never_free``), a row per number that is claimed, and (``at``, ``SSN``, ``wanted``) of the claims for other numbers that
    are refused, None if none can be. ``accounts`` has the ``SSN`` of every account, without repeats but for null.

    Claims with equal ``at`` count in the order of SSN and number. Most numbers need no look at the order: those of an account that claims
    nothing are never free, and those that one account alone claims are always. The others are contested, and all claims
    of the accounts that hold or claim them go through ``verdicts``."""
    claims = claims.distinct()
    claiming = claims.select(F.col("SSN").alias("wanted"), F.lit(True).alias("moves")).distinct()
    numbers = claims.groupBy("wanted").agg(F.min("SSN").alias("first"), F.max("SSN").alias("last"))
    holders = accounts.select(F.col("SSN").alias("wanted")).join(numbers.select("wanted"), "wanted", "left_semi")
    numbers = numbers.join(holders.distinct().withColumn("held", F.lit(True)), "wanted", "left").join(claiming, "wanted", "left")
    numbers = written(numbers.na.fill(False, ["held", "moves"]))
    never_free = F.col("held") & ~F.col("moves")
    by_others = (F.col("first") != F.col("wanted")) | (F.col("last") != F.col("wanted"))
    contested = numbers.filter(F.when(F.col("held"), F.col("moves") & by_others).otherwise(F.col("first") != F.col("last")))
    judged = numbers.select("wanted", never_free.alias("never_free"))
    if contested.isEmpty():
        return judged, None
    claimants = claims.join(contested.select("wanted"), "wanted", "left_semi").select("SSN")
    involved = claimants.union(contested.filter("held").select("wanted")).distinct()
    open_claims = claims.join(involved, "SSN", "left_semi").join(numbers.filter(never_free).select("wanted"), "wanted", "left_anti")
    found = verdicts(open_claims, numbers.filter("held").select("wanted"))
    return judged, found.filter(~F.col("ok")).select("at", "SSN", "wanted")


def verdicts(claims: DataFrame, held: DataFrame) -> DataFrame:
    """``claims``, without repeats, with ``ok``. ``held``: the ``wanted`` numbers that an account of these has at the beginning.

    All claims are taken to succeed at first. Of this follows, by running totals, which number each account has before each of its claims, and how
    many have the number that it asks for; and of that, which claims succeed. This is repeated until nothing changes. A
    claim is right one round after all that it depends on, so the rounds are as many as claims that depend on
    each other in a row, and the end is the result of one claim after the other."""
    claims, result = claims.select("at", "SSN", "wanted"), new_folder(claims.sparkSession)
    with passing_folder(claims.sparkSession) as passing:
        now, n = written(claims.withColumn("ok", F.lit(True)), f"{passing}/0"), 0
        while True:
            n += 1
            path = f"{passing}/{n}"
            got = F.when(F.col("ok"), F.col("wanted"))
            own = before(now.withColumn("got", got), "SSN", ["at", "wanted"], "got", _last, f"{path}-accounts")
            own = own.select("at", "SSN", "wanted", "ok", F.coalesce("before", "SSN").alias("has"))
            moves = own.filter(F.col("ok") & (F.col("has") != F.col("wanted")))
            # A claim sees what happened before it, so it stands before its own two events.
            asked = own.select(F.col("wanted").alias("number"), "*", F.lit(0).alias("change"))
            events = [moves.select(F.col(c).alias("number"), "*", F.lit(d).alias("change")) for c, d in (("wanted", 1), ("has", -1))]
            order = ["at", "SSN", "wanted", F.abs("change")]
            taken = before(asked.union(events[0]).union(events[1]), "number", order, "change", _sum, f"{path}-numbers").filter("change = 0")
            taken = taken.join(held.withColumn("at_first", F.lit(1)), "wanted", "left")
            owners = F.coalesce("at_first", F.lit(0)) + F.coalesce("before", F.lit(0))
            free = (F.col("has") == F.col("wanted")) | (owners <= 0)
            after = written(taken.select("at", "SSN", "wanted", "ok", free.alias("next")), f"{path}-next")
            if after.filter("ok != next").isEmpty():
                return written(after.select("at", "SSN", "wanted", "ok"), result)
            now = after.select("at", "SSN", "wanted", F.col("next").alias("ok"))


def _last(value: str) -> Column:
    return F.last(value, ignorenulls=True)


def _sum(value: str) -> Column:
    return F.sum(value)


def before(rows: DataFrame, key: str, order: list, value: str, running, path: str) -> DataFrame:
    """``rows`` with ``before``: the ``running`` aggregate (``_last`` or ``_sum``) of ``value`` over the earlier rows with the same ``key``, null if there are none.

    Rows are dealt by ranges of key and order, so one key with much of the rows is spread over tasks; each range adds what the ranges before it sum up
    to, of which a key has as many as there are tasks."""
    dealt = rows.repartitionByRange(key, *order).withColumn("range", F.spark_partition_id())
    dealt = written(dealt, path)
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = running(value).over(earlier(Window.partitionBy(key, "range").orderBy(*order)))
    if running is _last:
        place = F.struct(*order, F.col(value).alias("_value"))
        whole = F.max(F.when(F.col(value).isNotNull(), place))["_value"]
    else:
        whole = F.sum(value)
    ranges = dealt.groupBy(key, "range").agg(whole.alias("whole"))
    carried = running("whole").over(earlier(Window.partitionBy(key).orderBy("range")))
    ranges = ranges.select(key, "range", carried.alias("carried"))
    joined = dealt.withColumn("inside", inside).join(ranges, [key, "range"])
    both = F.coalesce("inside", "carried") if running is _last else F.coalesce("inside", F.lit(0)) + F.coalesce("carried", F.lit(0))
    return joined.withColumn("before", both).drop("range", "inside", "carried")
