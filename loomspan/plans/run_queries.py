"""Queries about a run as a whole: its order, its outcome, what it leaves behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.operators import calibration, metrics, monitoring
from loomspan.plans import adapters as ad
from loomspan.plans.oracles import _ATT

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _run(spark: SparkSession, d: str, limit: float) -> monitoring.Run:
    """All events as one run of attempts."""
    return monitoring.Run(ad.table(spark, d, "events").select("event_id", ad.reason().alias("reason")), "event_id", F.col("reason").isNotNull(), F.col("reason") == "structural_invalid", limit)


@query(f"""WITH {_ATT}, r AS (SELECT event_id, count(*) OVER w AS seen, count(*) FILTER (reason = 'structural_invalid') OVER w AS hits FROM att WINDOW w AS (ORDER BY event_id))
SELECT event_id AS seq, seen, hits, round(hits / seen, 9) AS rate FROM r WHERE seen >= 300 AND hits / seen > 0.197::DOUBLE ORDER BY event_id LIMIT 1""")
def run_first_breach(spark: SparkSession, d: str) -> DataFrame:
    """Where the rate of a reason over the run so far is first over the limit."""
    found = _run(spark, d, 0.197).first_breach(300)
    rows = [] if found is None else [(found["seq"], found["seen"], found["hits"], round(found["rate"], 9))]
    return spark.createDataFrame(rows, "seq long, seen long, hits long, rate double")


@query(f"""WITH {_ATT}, g AS (SELECT event_id, reason, sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY event_id) AS g FROM att),
c AS (SELECT count(*) AS longest, min(event_id) AS first_seq, max(event_id) AS last_seq FROM g WHERE reason IS NOT NULL GROUP BY g)
SELECT longest, first_seq, last_seq FROM c ORDER BY longest DESC, first_seq LIMIT 1""")
def run_longest_failure(spark: SparkSession, d: str) -> DataFrame:
    """The longest run of failed attempts over all of them."""
    return _run(spark, d, 1.0).longest_failure()


@query("""WITH r AS (SELECT rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS a,
rank() OVER (ORDER BY l_quantity * (1 + l_tax)) + (count(*) OVER (PARTITION BY l_quantity * (1 + l_tax)) - 1) / 2 AS b FROM lineitem)
SELECT count(*) AS n, round(corr(a, b), 8) AS rho FROM r""")
def spearman_continuous(spark: SparkSession, d: str) -> DataFrame:
    """Rank correlation of two columns of many different values."""
    pairs = ad.table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("judge"), (F.col("l_quantity") * (1 + F.col("l_tax"))).alias("human"))
    return calibration.spearman(pairs).select("n", F.round("rho", 8).alias("rho"))


@query("""WITH o AS (SELECT l_returnflag AS flag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem),
a AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS k, count(*) OVER () AS n FROM lineitem)
SELECT flag, v AS median FROM o WHERE k = n // 2 UNION ALL SELECT 'all', v FROM a WHERE k = n // 2""")
def median_continuous(spark: SparkSession, d: str) -> DataFrame:
    """Upper medians of a column of many different values, per group and of all."""
    prices = ad.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("v"))
    return metrics.upper_median(prices, "v", "flag").unionByName(metrics.upper_median(prices, "v").select(F.lit("all").alias("flag"), "median"))
