"""The operators bound to the driver's tables, with DuckDB SQL for each."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import scalar
from tidegauge.operators import consistency, findings, fuzzy, names, realign, report, sequence, stats, tables, vote
from tidegauge.plans import extract, merge, pages, timetable
from tidegauge.sources import ocr, runs, sinks
from tidegauge.sources.shared import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as the query of its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros():
    """Microseconds of ts since 1970, whatever the session's time zone."""
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")


def second_of_day():
    return F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")


SQL_SECOND = "CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT)"
SQL_DEV = """CASE WHEN mad <> 0 THEN abs(0.6745 * (x - med) / mad)
                  WHEN med = 0 OR x = 0 THEN CASE WHEN x = med THEN 0.0 ELSE 'inf'::DOUBLE END
                  WHEN x > med THEN x / med ELSE med / x END"""


def _scored(samples: str, keys: str, ratio: float, min_diff: float) -> str:
    """SQL of group_outliers over `samples` (..., x)."""
    return f"""s AS ({samples}),
         m AS (SELECT {keys}, count(*) AS n, median(x) AS med, mad(x) AS mad FROM s GROUP BY {keys}),
         d AS (SELECT s.*, n, med, mad, {SQL_DEV} AS dev FROM s JOIN m USING ({keys}) WHERE n >= 5),
         o AS (SELECT * FROM d WHERE dev > CASE WHEN mad <> 0 THEN 3.5 ELSE {ratio} END AND abs(x - med) >= {min_diff})"""


SQL_LEGS = """SELECT event_id, user_id, event_type AS from_, next_type AS to_, CAST((next_us - us) // 1000000 AS BIGINT) AS x FROM (
        SELECT *, epoch_us(ts) AS us, lead(event_type) OVER w AS next_type, lead(epoch_us(ts)) OVER w AS next_us
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
      WHERE next_type IS NOT NULL AND event_type <> '' AND next_type <> ''"""


def _legs(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts").withColumn("us", micros())
    out = sequence.legs(ev, ["user_id"], ["ts", "event_id"], "event_type", F.col("us"), F.col("us"))
    return out.select("event_id", "user_id", "from_", "to_", "us", F.floor(F.col("dt") / 1000000).alias("dt"))


@query(f"""WITH {_scored(SQL_LEGS, "from_, to_", 1.5, 60)}
    SELECT event_id, from_, to_, x AS dt, n, round(med, 3) AS med, round(mad, 3) AS mad, round(dev, 6) AS dev FROM o""")
def leg_outliers(spark, sf):
    """Running times between events that deviate from those of the same leg (directed)."""
    o = stats.group_outliers(_legs(spark, sf), ["from_", "to_"], "dt", ratio=1.5, min_diff=60)
    return o.select("event_id", "from_", "to_", "dt", "n", F.round("med", 3).alias("med"), F.round(F.col("mad").cast("double"), 3).alias("mad"), F.round("dev", 6).alias("dev"))


@query(f"""WITH {_scored("SELECT event_id, event_type, value AS x FROM events WHERE value IS NOT NULL", "event_type", 2.0, 120)}
    SELECT event_id, event_type, n, round(dev, 6) AS dev FROM o""")
def dwell_outliers(spark, sf):
    """Values that deviate from those of their event type."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "value").where("value is not null")
    return stats.group_outliers(ev, ["event_type"], "value", ratio=2.0, min_diff=120).select("event_id", "event_type", "n", F.round("dev", 6).alias("dev"))


@query(f"""WITH {_scored("SELECT event_id, event_type, floor(value / 100) + 1 AS x FROM events WHERE value IS NOT NULL", "event_type", 1.5, 0)}
    SELECT event_id, event_type, CAST(x AS BIGINT) AS x, round(dev, 6) AS dev FROM o""")
def ratio_fallback(spark, sf):
    """The ratio that stands in for the z score where MAD is 0."""
    ev = table(spark, sf, "events").where("value is not null").select("event_id", "event_type", (F.floor(F.col("value") / 100) + 1).cast("double").alias("x"))
    return stats.group_outliers(ev, ["event_type"], "x", ratio=1.5).select("event_id", "event_type", F.col("x").cast("bigint").alias("x"), F.round("dev", 6).alias("dev"))


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice / l_quantity AS x FROM lineitem WHERE l_quantity <> 0),
         m AS (SELECT median(x) AS med FROM s), a AS (SELECT median(abs(x - med)) AS mad FROM s, m)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(x, 6) AS rate, round(abs(0.6745 * (x - med) / mad), 6) AS dev
    FROM s, m, a WHERE mad <> 0 AND abs(0.6745 * (x - med) / mad) > 3.5""")
def global_rate_outliers(spark, sf):
    """Unit prices that deviate from all others."""
    li = table(spark, sf, "lineitem").where("l_quantity <> 0").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("x"))
    o = stats.global_outliers(li, "x")
    return o.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("x", 6).alias("rate"), F.round("dev", 6).alias("dev"))


@query(f"""WITH a AS (SELECT event_id, user_id, ts, {SQL_SECOND} AS s FROM events),
         b AS (SELECT *, lag(s) OVER w AS p, row_number() OVER w AS i FROM a WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         c AS (SELECT *, min(CASE WHEN s = 86400 OR (s < p AND p % 86400 >= 72000 AND s <= 28800) THEN i END) OVER (PARTITION BY user_id) AS wr FROM b),
         d AS (SELECT *, CASE WHEN wr IS NULL OR i < wr OR (i = wr AND s = 86400) THEN s ELSE s + 86400 END AS v FROM c)
    SELECT event_id, CAST(v AS BIGINT) AS v, coalesce(v < lag(v) OVER w, false) AS back, v <> s AS wrapped
    FROM d WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def clock_wrap(spark, sf):
    """The cumulative clock of a user's events by second of day."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", second_of_day().cast("bigint").alias("s"))
    return sequence.clock(ev, ["user_id"], ["ts", "event_id"], "s").select("event_id", "v", "back", "wrapped")


@query("""SELECT l_orderkey, count(*) AS n_back FROM (
        SELECT l_orderkey, l_quantity, lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS p FROM lineitem)
    WHERE l_quantity < p GROUP BY l_orderkey""")
def backward_steps(spark, sf):
    """Steps back of a quantity along an order's lines, on a clock that never reaches midnight."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    li = table(spark, sf, "lineitem").where("l_quantity is not null").select("l_orderkey", *order)
    return sequence.clock(li, ["l_orderkey"], order, "l_quantity").where("back").groupBy("l_orderkey").agg(F.count("*").alias("n_back"))


@query("""WITH f AS (
        SELECT l_orderkey,
               l_extendedprice < lag(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS d,
               l_extendedprice < lag(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS u
        FROM lineitem WHERE l_extendedprice IS NOT NULL),
      g AS (SELECT l_orderkey, count(*) FILTER (d) AS down, count(*) FILTER (u) AS up FROM f GROUP BY l_orderkey)
    SELECT l_orderkey, down, up, CASE WHEN down < up THEN 1 WHEN up < down THEN -1 WHEN down = 0 THEN 1 END AS direction FROM g""")
def direction_fit(spark, sf):
    """Whether an order's prices rise down or up its lines."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return sequence.direction(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_extendedprice")


@query("""SELECT event_id, user_id FROM (
        SELECT *, event_type <> 'error' AS s, lag(event_type <> 'error') OVER w AS b, lead(event_type <> 'error') OVER w AS a
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE NOT s AND a AND b""")
def isolated_gaps(spark, sf):
    """Single errors between two other events."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return sequence.isolated_gaps(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") != "error").select("event_id", "user_id")


@query("""WITH RECURSIVE r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events WHERE value IS NOT NULL),
      z AS (SELECT user_id, pos, value, 0 AS zone, 0 AS dir FROM r WHERE pos = 1
            UNION ALL
            SELECT user_id, pos, value, zone + CASE WHEN brk THEN 1 ELSE 0 END, CASE WHEN brk THEN 0 WHEN sg <> 0 THEN sg ELSE dir END FROM (
                SELECT r.user_id, r.pos, r.value, z.zone, z.dir, CAST(sign(r.value - z.value) AS INTEGER) AS sg,
                       abs(r.value - z.value) > 60 OR (z.dir <> 0 AND sign(r.value - z.value) <> 0 AND sign(r.value - z.value) <> z.dir) AS brk
                FROM z JOIN r ON r.user_id = z.user_id AND r.pos = z.pos + 1))
    SELECT user_id, CAST(pos AS BIGINT) AS pos, CAST(zone AS BIGINT) AS zone, value FROM z""")
def zones(spark, sf):
    """Zones of a user's values: a break where a step exceeds 60 or turns."""
    ev = table(spark, sf, "events").where("value is not null").select("user_id", "ts", "event_id", "value")
    return sequence.zones(ev, ["user_id"], ["ts", "event_id"], "value", 60).select("user_id", F.col("pos").cast("bigint").alias("pos"), F.col("zone").cast("bigint").alias("zone"), "value")


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events""")
def carry_forward(spark, sf):
    """The last signup's value at each event."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return sequence.carry_forward(ev, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("value")), "carried").select("event_id", "carried")


@query("""WITH n AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
      g AS (SELECT user_id, i, i - row_number() OVER (PARTITION BY user_id ORDER BY i) AS g FROM n WHERE event_type = 'error')
    SELECT user_id, CAST(min(i) AS BIGINT) AS first, CAST(max(i) AS BIGINT) AS last, count(*) AS size FROM g GROUP BY user_id, g HAVING count(*) >= 3""")
def islands(spark, sf):
    """Runs of three errors or more."""
    ev = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return sequence.islands(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 3).select("user_id", F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"), "size")


@query("""WITH a AS (SELECT event_id, user_id, ts, epoch_us(ts) AS lo, epoch_us(ts) + CAST(floor(value * 1e8) AS BIGINT) AS hi FROM events WHERE value IS NOT NULL),
      b AS (SELECT *, max(hi) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM a)
    SELECT event_id, CAST(sum(CASE WHEN m IS NULL OR lo >= m THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS grp FROM b""")
def running_max_groups(spark, sf):
    """Events that begin before an earlier one's interval ends share its group."""
    ev = table(spark, sf, "events").where("value is not null").select("event_id", "user_id", "ts", "value").withColumn("us", micros())
    high = F.col("us") + F.floor(F.col("value") * 1e8).cast("bigint")
    return sequence.running_groups(ev, ["user_id"], ["ts", "event_id"], F.col("us"), high).select("event_id", F.col("grp").cast("bigint").alias("grp"))


SQL_CELL = """CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '—' WHEN 2 THEN printf('%dO.%02d', hour(ts), minute(ts)) WHEN 3 THEN 'note'
    WHEN 4 THEN printf('%02d.%02d,5', hour(ts), minute(ts)) WHEN 5 THEN printf('%02d.%02d', hour(ts) + 10, minute(ts) + 20) ELSE printf('%d.%02d', hour(ts), minute(ts)) END"""


def _cells(spark, sf):
    h, m = F.hour("ts"), F.minute("ts")
    two = lambda c: F.when(c < 10, F.concat(F.lit("0"), c.cast("string"))).otherwise(c.cast("string"))
    k = F.col("event_id") % 7
    cell = (
        F.when(k == 0, "").when(k == 1, "—").when(k == 2, F.concat(h.cast("string"), F.lit("O."), two(m))).when(k == 3, "note")
        .when(k == 4, F.concat(two(h), F.lit("."), two(m), F.lit(",5"))).when(k == 5, F.concat(two(h + 10), F.lit("."), two(m + 20)))
        .otherwise(F.concat(h.cast("string"), F.lit("."), two(m)))
    )
    return table(spark, sf, "events").select("event_id", cell.alias("cell"))


@query(f"""WITH c AS (SELECT event_id, {SQL_CELL} AS cell FROM events),
      p AS (SELECT *, regexp_extract(cell, '^([0-9]{{1,2}})[.]([0-9]{{2}})(,5)?$', 1) AS h, regexp_extract(cell, '^([0-9]{{1,2}})[.]([0-9]{{2}})(,5)?$', 2) AS m FROM c),
      q AS (SELECT *, CASE WHEN h <> '' AND CAST(m AS INT) <= 59 AND (CAST(h AS INT) < 24 OR (CAST(h AS INT) = 24 AND CAST(m AS INT) = 0))
                      THEN CAST(h AS INT) * 3600 + CAST(m AS INT) * 60 + CASE WHEN cell LIKE '%,5' THEN 30 ELSE 0 END END AS sec FROM p)
    SELECT event_id, CAST(sec AS BIGINT) AS sec,
           CASE WHEN cell = '' THEN 'blank' WHEN cell IN ('—', '-', '–') THEN 'pass' WHEN sec IS NOT NULL THEN 'time' WHEN regexp_matches(cell, '[0-9]') THEN 'bad' ELSE 'note' END AS kind FROM q""")
def time_classify(spark, sf):
    """Cells as blank, pass, time, bad or note, and the seconds of times."""
    c = F.col("cell")
    return _cells(spark, sf).select("event_id", scalar.time_seconds(c).cast("bigint").alias("sec"), scalar.cell_kind(c).alias("kind"))


@query(rf"""WITH c AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '**' || cell || '**' WHEN 1 THEN ' ' || cell || ' ' WHEN 2 THEN cell || ' ' || cell ELSE cell || '\*' END AS cell FROM (SELECT event_id, {SQL_CELL} AS cell FROM events)),
      s AS (SELECT event_id, trim(cell) AS t FROM c),
      e AS (SELECT event_id, CASE WHEN length(t) > 4 AND starts_with(t, '**') AND ends_with(t, '**') THEN t[3:-3] WHEN t = '****' THEN '**' ELSE t END AS t FROM s),
      u AS (SELECT event_id, replace(t, '\*', '*') AS t FROM e)
    SELECT event_id, t AS kept, regexp_replace(t, '\b([0-9])\.([0-9]{{2}})\b', '0\1.\2', 'g') AS cell FROM u""")
def clean_cell(spark, sf):
    """Cells without emphasis, escapes and outer space, with lone hours padded, and as columns of names keep them."""
    k, c = F.col("event_id") % 4, F.col("cell")
    dirty = F.when(k == 0, F.concat(F.lit("**"), c, F.lit("**"))).when(k == 1, F.concat(F.lit(" "), c, F.lit(" "))).when(k == 2, F.concat(c, F.lit(" "), c)).otherwise(F.concat(c, F.lit("\\*")))
    return _cells(spark, sf).select("event_id", scalar.clean_cell(dirty, pad_time=False).alias("kept"), scalar.clean_cell(dirty).alias("cell"))


@query("""WITH k AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN printf('%d,%d', abs(CAST(floor(c_acctbal) AS BIGINT)), c_custkey % 10) WHEN 1 THEN printf('%d.%d', c_custkey, c_custkey % 10) ELSE 'km' END AS km FROM customer)
    SELECT c_custkey, CASE WHEN regexp_matches(km, '^[0-9]{1,4}[.,][0-9]$') THEN CAST(regexp_replace(km, '[.,]', '') AS BIGINT) END AS tenths FROM k""")
def km_parse(spark, sf):
    """Kilometres in tenths."""
    k, key = F.col("c_custkey") % 3, F.col("c_custkey")
    digit = (key % 10).cast("string")
    km = F.when(k == 0, F.concat(F.abs(F.floor("c_acctbal")).cast("string"), F.lit(","), digit)).when(k == 1, F.concat(key.cast("string"), F.lit("."), digit)).otherwise("km")
    return table(spark, sf, "customer").select("c_custkey", scalar.km_tenths(km).cast("bigint").alias("tenths"))


@query(f"""SELECT event_id, printf('%02d.%02d', s // 3600 % 24, s // 60 % 60) || CASE WHEN s % 60 <> 0 THEN ',5' ELSE '' END AS hhmm,
           CASE WHEN event_id % 2 = 1 THEN '-' ELSE '' END || (s // 60) || ':' || printf('%02d', s % 60) AS mmss
    FROM (SELECT event_id, {SQL_SECOND} AS s FROM events) WHERE s > 0""")
def clock_text(spark, sf):
    """Seconds as HH.MM[,5] and as signed M:SS."""
    s = F.col("s")
    ev = table(spark, sf, "events").select("event_id", second_of_day().cast("bigint").alias("s")).where("s > 0")
    return ev.select("event_id", scalar.hhmm(s).alias("hhmm"), scalar.mmss(F.when(F.col("event_id") % 2 == 1, -s).otherwise(s)).alias("mmss"))


@query("""WITH c AS (SELECT p_brand, p_type, count(*) AS n, min(p_partkey) AS s FROM part GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, s) AS k FROM c),
      b AS (SELECT p_brand, p_type AS best, n AS n_best FROM r WHERE k = 1)
    SELECT p_brand, p_type, n, best, n_best, 8 + n_best - n AS score FROM r JOIN b USING (p_brand) WHERE k > 1""")
def fd_violations(spark, sf):
    """Types that are not their brand's most frequent."""
    return consistency.dependency_violations(table(spark, sf, "part").select("p_brand", "p_type", "p_partkey"), ["p_brand"], "p_type", "p_partkey")


BANDS = [("low", -1000.0, 9000.0), ("all", -1000.0, 10000.0), ("high", 0.0, 10000.0)]


@query("""WITH b(name, lo, hi) AS (VALUES ('low', -1000.0, 9000.0), ('all', -1000.0, 10000.0), ('high', 0.0, 10000.0)),
      f AS (SELECT s_nationkey, name FROM supplier, b GROUP BY s_nationkey, name, lo, hi HAVING bool_and(s_acctbal BETWEEN lo AND hi))
    SELECT s_nationkey, CASE WHEN count(name) = 1 THEN min(name) END AS band FROM (SELECT DISTINCT s_nationkey FROM supplier) LEFT JOIN f USING (s_nationkey) GROUP BY s_nationkey""")
def band_classify(spark, sf):
    """The only band that holds all of a nation's balances."""
    bands = spark.createDataFrame(BANDS, "name string, lo double, hi double")
    return consistency.classify_bands(table(spark, sf, "supplier").select("s_nationkey", "s_acctbal"), ["s_nationkey"], "s_acctbal", bands)


@query("""WITH r AS (SELECT l_partkey, l_suppkey % 3 AS run, arg_min(l_returnflag, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_returnflag)) AS v FROM lineitem GROUP BY ALL),
      g AS (SELECT l_partkey, v, count(*) AS n, min(run) AS f FROM r GROUP BY ALL),
      k AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, f) AS k FROM g)
    SELECT l_partkey, max(v) FILTER (k = 1) AS value, max(n) FILTER (k = 1) AS votes, count(*) AS n_readings, count(*) = 1 AS agreed, string_agg(v, ' ¦ ' ORDER BY k) AS readings FROM k GROUP BY l_partkey""")
def vote_cells(spark, sf):
    """Three readings of a part's flag, merged by vote."""
    li = table(spark, sf, "lineitem").select("l_partkey", (F.col("l_suppkey") % 3).alias("run"), F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag").alias("o"))
    r = li.groupBy("l_partkey", "run").agg(F.min("o")["l_returnflag"].alias("v"))
    return vote.vote(r, ["l_partkey"], "run", "v")


@query("""WITH s AS (SELECT conv_id, string_agg(role, '>' ORDER BY turn, text) AS sig FROM conversations GROUP BY conv_id),
      n AS (SELECT conv_id // 4 AS unit, sig, count(DISTINCT conv_id % 4) AS n_runs, min(conv_id % 4) AS f FROM s GROUP BY ALL),
      k AS (SELECT *, row_number() OVER w AS k, lead(n_runs) OVER w AS nx FROM n WINDOW w AS (PARTITION BY unit ORDER BY n_runs DESC, f, sig))
    SELECT unit, sig, n_runs, n_runs >= 2 AND NOT coalesce(nx = n_runs, false) AS kept FROM k WHERE k = 1""")
def layout_majority(spark, sf):
    """The order of roles that most of four conversations share."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    s = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))), lambda x: x["role"]), ">").alias("sig"))
    s = s.select(F.floor(F.col("conv_id") / 4).alias("unit"), (F.col("conv_id") % 4).alias("run"), "sig")
    return vote.layout_majority(s, ["unit"], "run", "sig")


@query("""WITH n AS (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY conv_id),
      g AS (SELECT conv_id // 4 AS unit, turns, count(*) AS n, min(conv_id % 4) AS f FROM n GROUP BY ALL)
    SELECT unit, turns FROM g QUALIFY row_number() OVER (PARTITION BY unit ORDER BY n DESC, f) = 1""")
def page_count_majority(spark, sf):
    """The number of turns that most of four conversations have."""
    n = table(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"))
    return vote.count_majority(n.select(F.floor(F.col("conv_id") / 4).alias("unit"), (F.col("conv_id") % 4).alias("run"), "turns"), ["unit"], "run", "turns")


@query("""WITH s AS (SELECT conv_id, string_agg(role, chr(10) ORDER BY turn, text) AS txt FROM conversations GROUP BY conv_id)
    SELECT conv_id // 4 AS unit, txt, string_agg(CAST(conv_id % 4 AS VARCHAR), ',' ORDER BY conv_id % 4) AS runs, CAST(max(len(string_split(txt, chr(10)))) AS BIGINT) AS n_lines FROM s GROUP BY ALL""")
def text_groups(spark, sf):
    """Conversations of one unit whose texts agree."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    s = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))), lambda x: x["role"]), "\n").alias("txt"))
    out = vote.text_groups(s.select(F.floor(F.col("conv_id") / 4).alias("unit"), (F.col("conv_id") % 4).alias("run"), "txt"), ["unit"], "run", "txt")
    return out.withColumn("n_lines", F.col("n_lines").cast("bigint"))


@query("""WITH c AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events WHERE event_id % 3 <> 0),
      h AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_id % 3 = 0 GROUP BY ALL)
    SELECT event_id, user_id, event_type FROM c JOIN h USING (user_id, event_type) WHERE k <= n""")
def prune_multiset(spark, sf):
    """Claims while unclaimed occurrences of their mark remain."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return vote.prune(ev.where("event_id % 3 <> 0"), ev.where("event_id % 3 = 0"), ["user_id", "event_type"], ["event_id"]).select("event_id", "user_id", "event_type")


def _finding_tables(spark, sf):
    o = leg_outliers(spark, sf).select("event_id", "from_", "to_", F.array(F.lit(4)).alias("rules"), F.array(F.col("dt").cast("string")).alias("vals"))
    e = _legs(spark, sf).where("event_id % 5 = 0").select("event_id", "from_", "to_", F.when(F.col("event_id") % 2 == 0, F.array(F.lit(2), F.lit(4))).otherwise(F.array(F.lit(2))).alias("rules"), F.array(F.col("dt").cast("string")).alias("vals"))
    return consistency.unmatched(o, e, ["event_id", "from_", "to_"], "rules", "vals")


@query(f"""WITH {_scored(SQL_LEGS, "from_, to_", 1.5, 60)}
    SELECT event_id, from_, to_ FROM o WHERE event_id % 10 <> 0""")
def ignore_antijoin(spark, sf):
    """Findings that no ignore entry covers with at least their rules."""
    return _finding_tables(spark, sf)[0].select("event_id", "from_", "to_")


@query(f"""WITH {_scored(SQL_LEGS, "from_, to_", 1.5, 60)}
    SELECT event_id, from_, to_ FROM s WHERE event_id % 5 = 0 AND NOT (event_id % 2 = 0 AND event_id IN (SELECT event_id FROM o))""")
def stale_ignores(spark, sf):
    """Ignore entries that cover no finding."""
    return _finding_tables(spark, sf)[1].select("event_id", "from_", "to_")


@query("""WITH n AS (SELECT DISTINCT lower(p_name) AS key FROM part WHERE p_name IS NOT NULL)
    SELECT x, y, d FROM (SELECT a.key AS x, b.key AS y, levenshtein(a.key, b.key) AS d FROM n a JOIN n b ON a.key < b.key AND abs(length(a.key) - length(b.key)) <= 3)
    WHERE d BETWEEN 1 AND 3 AND d / least(length(x), length(y)) <= 0.5""")
def fuzzy_pairs(spark, sf):
    """Part names within three edits."""
    n = table(spark, sf, "part").select(F.lower("p_name").alias("key"))
    return fuzzy.fuzzy_pairs(n, 3, 0.5).withColumn("d", F.col("d").cast("bigint"))


@query("""WITH w AS (SELECT DISTINCT replace(lower(p_name), ' ', '') AS joined FROM part), v AS (SELECT DISTINCT left(joined, length(joined) - 1) AS word FROM w UNION SELECT 'x' || joined FROM w)
    SELECT joined, min(word) AS match FROM w JOIN v ON abs(length(joined) - length(word)) <= 1 AND levenshtein(joined, word) <= 1 GROUP BY joined""")
def hyphen_joins(spark, sf):
    """Words joined at a break, looked up in a vocabulary within one edit: the least match."""
    w = table(spark, sf, "part").where("p_name is not null").select(F.replace(F.lower("p_name"), F.lit(" "), F.lit("")).alias("key")).distinct()
    v = w.select(F.expr("left(key, length(key) - 1)").alias("key")).union(w.select(F.concat(F.lit("x"), "key"))).distinct()
    near = fuzzy.within_distance(w, v, 1).select(F.col("x").alias("joined"), F.col("y").alias("match"))
    return near.unionByName(w.join(v, "key").select(F.col("key").alias("joined"), F.col("key").alias("match"))).groupBy("joined").agg(F.min("match").alias("match"))


@query("""SELECT regexp_replace(s_name, '[0-9]+(,[0-9]+)?', '#', 'g') AS shape, count(*) AS n, min(s_name) AS first_name FROM supplier GROUP BY shape
    UNION ALL SELECT regexp_replace(c_name, '[0-9]+(,[0-9]+)?', '#', 'g'), count(*), min(c_name) FROM customer GROUP BY 1""")
def number_shape(spark, sf):
    """Names grouped by their shape without numbers."""
    out = None
    for t, c in (("supplier", "s_name"), ("customer", "c_name")):
        g = table(spark, sf, t).groupBy(scalar.number_shape(F.col(c)).alias("shape")).agg(F.count("*").alias("n"), F.min(c).alias("first_name"))
        out = g if out is None else out.unionByName(g)
    return out


SQL_NAMES = """SELECT p_name, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b, p_size % 5 + 1 AS v, p_size // 5 % 5 + 1 AS r FROM part WHERE p_name IS NOT NULL"""
ROMAN_SQL = "['I', 'II', 'III', 'IV', 'V']"


def _part_names(spark, sf):
    """Part names as printed in several notations: with an Arabic or a Roman number, and with the first word cut short."""
    p = table(spark, sf, "part").where("p_name is not null").select("p_name", F.split("p_name", " ").alias("w"), (F.col("p_size") % 5 + 1).cast("string").alias("v"), (F.floor(F.col("p_size") / 5) % 5 + 1).cast("int").alias("r"))
    roman = F.element_at(F.array(*map(F.lit, names.ROMAN)), F.col("r"))
    cut = F.concat(F.substring(F.get("w", F.lit(0)), 1, 2), F.lit(". "), F.get("w", F.lit(1)), F.lit(" "), F.col("v"))
    slash = F.concat(F.substring(F.get("w", F.lit(0)), 1, 1), F.lit("/"), F.get("w", F.lit(1)))
    return p.select(F.explode(F.array(F.concat("p_name", F.lit(" "), "v"), F.concat("p_name", F.lit(" "), roman), cut, slash)).alias("name"))


@query(f"""WITH s AS ({SQL_NAMES}),
      p AS (SELECT DISTINCT 'end' AS place, 'Roman number' AS key, '… I…' AS printed, p_name || ' ' || {ROMAN_SQL}[r] AS name FROM s
            UNION SELECT 'front', left(a, 2), left(a, 2) || '. …', left(a, 2) || '. ' || b || ' ' || v FROM s
            UNION SELECT 'front', left(a, 1), left(a, 1) || '/…', left(a, 1) || '/' || b FROM s)
    SELECT place, key, printed, count(*) AS n FROM p GROUP BY ALL""")
def notation_parts(spark, sf):
    """The notation parts of names, and how many distinct names print each."""
    return names.notation_parts(_part_names(spark, sf), "name").groupBy("place", "key", "printed").agg(F.count("*").alias("n"))


@query("""WITH RECURSIVE n AS (SELECT DISTINCT lower(p_name) AS k FROM part WHERE p_name IS NOT NULL),
      e AS (SELECT a.k AS u, b.k AS v FROM n a JOIN n b ON a.k <> b.k AND abs(length(a.k) - length(b.k)) <= 2 AND levenshtein(a.k, b.k) <= 2),
      r AS (SELECT u AS node, u AS c FROM e UNION SELECT e.u, r.c FROM r JOIN e ON e.v = r.node)
    SELECT node, min(c) AS component FROM r GROUP BY node""")
def name_components(spark, sf):
    """Names linked over two edits or fewer, with their component's least name."""
    n = table(spark, sf, "part").select(F.lower("p_name").alias("key"))
    return fuzzy.components(fuzzy.within_distance(n, n, 2).select(F.col("x").alias("u"), F.col("y").alias("v")))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
      b AS (SELECT doc_id, line, regexp_replace(regexp_replace(t, '^\s*\|', ''), '\|\s*$', '') AS b FROM l
            WHERE contains(t, '|') AND NOT regexp_matches(t, '^\s*\|?(\s*:?-+:?\s*\|)*\s*:?-+:?\s*\|?\s*$') AND NOT regexp_matches(t, '^\s*\|?(\s*=+\s*\|)*\s*=+\s*\|?\s*$')),
      c AS (SELECT doc_id, line, unnest(string_split(b, '|')) AS c, generate_subscripts(string_split(b, '|'), 1) - 1 AS col FROM b),
      n AS (SELECT doc_id, line, count(*) AS n_cells, sum(length(regexp_replace(c, '^[ \t\r]+|[ \t\r]+$', '', 'g'))) AS chars FROM c GROUP BY ALL)
    SELECT doc_id, CAST(line AS BIGINT) AS line, n_cells, max(n_cells) OVER (PARTITION BY doc_id) AS width, CAST(chars AS BIGINT) AS chars FROM n""")
def pipe_parse(spark, sf):
    """Cells of the documents' pipe-table lines, and each row's place in its table's width."""
    lines = tables.text_lines(table(spark, sf, "documents").where(F.contains("text", F.lit("|"))), "doc_id", "text")
    cells = tables.pipe_cells(lines, "doc_id")
    chars = cells.groupBy("doc_id", "line").agg(F.count("*").alias("n_cells"), F.sum(F.length("cell")).alias("chars"))
    from pyspark.sql import Window

    return chars.select("doc_id", F.col("line").cast("bigint").alias("line"), "n_cells", F.max("n_cells").over(Window.partitionBy("doc_id")).alias("width"), "chars")


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
      c AS (SELECT l_orderkey AS tab, l_partkey AS r, 0 AS c, 'part ' || l_partkey AS t FROM l UNION ALL SELECT l_orderkey, l_partkey, 1, CAST(l_partkey * 7 AS VARCHAR) FROM l),
      w AS (SELECT *, max(length(t)) OVER (PARTITION BY tab, c) AS w FROM c)
    SELECT tab, r, '| ' || string_agg(rpad(t, CAST(w AS INTEGER), ' '), ' | ' ORDER BY c) || ' |' AS line FROM w GROUP BY tab, r""")
def table_render(spark, sf):
    """An order's parts as aligned rows."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tab"), F.col("l_partkey").alias("r")).distinct()
    cells = li.select("tab", "r", F.posexplode(F.array(F.concat(F.lit("part "), F.col("r").cast("string")), (F.col("r") * 7).cast("string"))).alias("c", "t"))
    return tables.render_table(cells, ["tab"], "r", "c", "t")


@query("""WITH a AS (SELECT c_nationkey AS k, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos FROM customer),
      b AS (SELECT s_nationkey AS k, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS pos FROM supplier)
    SELECT k, pos, c_custkey, s_suppkey FROM a FULL JOIN b USING (k, pos)""")
def zip_streams(spark, sf):
    """Customers and suppliers of a nation, joined by position."""
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), "c_custkey")
    b = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), "s_suppkey")
    return consistency.zip_streams(a, b, ["k"], ["c_custkey"], ["s_suppkey"]).withColumn("pos", F.col("pos").cast("bigint"))


@query("""SELECT doc_id, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) = 1 AS first FROM documents""")
def keep_first(spark, sf):
    """Whether a document's text is seen for the first time."""
    d = table(spark, sf, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return consistency.first_seen(d, ["h"], ["doc_id"]).select("doc_id", "first")


@query("""WITH n AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
      l AS (SELECT *, max(CASE WHEN event_type <> 'error' THEN i END) OVER (PARTITION BY user_id) AS l FROM n)
    SELECT event_id, user_id FROM l WHERE i > coalesce(l, 0)""")
def trailing_blanks(spark, sf):
    """Errors after a user's last other event."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return sequence.trailing(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error").select("event_id", "user_id")


@query("""WITH f AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS sev, floor(value) AS sc, 1 + event_id % 3 AS nr FROM events WHERE value IS NOT NULL)
    SELECT event_id, round(sc * (1 + 0.5 * (nr - 1)), 3) AS weighted, row_number() OVER (ORDER BY sev, sc * (1 + 0.5 * (nr - 1)) DESC, event_id) AS rank FROM f""")
def rank_findings(spark, sf):
    """Findings by severity, weighted score and order."""
    f = table(spark, sf, "events").where("value is not null").select("event_id", F.when(F.col("event_type") == "error", 0).otherwise(1).alias("sev"), F.floor("value").alias("sc"), (1 + F.col("event_id") % 3).alias("nr"))
    r = consistency.rank_findings(f, "sev", "sc", "nr", ["event_id"])
    return r.select("event_id", F.round("weighted", 3).cast("double").alias("weighted"), F.col("rank").cast("bigint").alias("rank"))


@query("""SELECT CASE c_nationkey % 4 WHEN 0 THEN 'suburban' WHEN 1 THEN 'two-way' WHEN 2 THEN 'distance' END AS shape, CASE WHEN c_nationkey % 4 = 1 THEN 3 ELSE 2 END AS width, count(*) AS n FROM customer GROUP BY ALL""")
def shape_tally(spark, sf):
    """Tables by the shape that their first row shows, and their width; unknown ones have none."""
    k = F.col("c_nationkey") % 4
    head = F.when(k == 0, "| № поездов | 61 |").when(k == 1, "| приб. | отпр. | Раздельные пункты |").when(k == 2, "| Раздельные пункты | Расстояние км |").otherwise("| what | is |")
    text = F.concat(head, F.lit("\n|---|---|\n| "), F.col("c_name"), F.lit(" | 7.10 |"))
    blocks = tables.read_gfm(table(spark, sf, "customer").select(F.col("c_custkey").alias("scan"), F.lit(0).alias("half"), F.lit(0).alias("y0"), F.lit(1).alias("pos"), F.lit("table").alias("type"), text.alias("t")), "t")
    return extract.page_shapes(blocks).groupBy("shape", "width").agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, count(*) AS n_lines, count(*) FILTER (regexp_matches(t, '^[ \t\r\f]*$') OR regexp_matches(t, '^[0-9]{1,3}$') OR regexp_matches(t, '^[0-9]+\s*(—\s*[0-9]+|\\?\*)$')) AS n_noise
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents) GROUP BY doc_id""")
def noise_filter(spark, sf):
    """Noise lines of each document."""
    lines = tables.text_lines(table(spark, sf, "documents").where("text is not null"), "doc_id", "text")
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(scalar.is_noise(F.col("text"))).alias("n_noise"))


@query("""SELECT vec_id, CASE WHEN embedding[1] + embedding[2] < 0 THEN 0 ELSE 1 END AS half FROM embeddings WHERE embedding IS NOT NULL""")
def half_split(spark, sf):
    """Which half a box's centre falls in, on a page whose middle is 0."""
    v = F.col("embedding")
    boxes = table(spark, sf, "embeddings").where("embedding is not null").select("vec_id", v[0].alias("x0"), v[1].alias("x1"), F.lit(0).alias("page_w"), F.lit(-1).alias("page_h"))
    return ocr.split_halves(boxes).select("vec_id", "half")


@query(r"""WITH l AS (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
      r AS (SELECT doc_id, sum(CASE WHEN starts_with(t, '#') THEN 2.0::DOUBLE ELSE 0.9::DOUBLE * greatest(1.0::DOUBLE, length(t) / 60.0::DOUBLE) + 0.4::DOUBLE END) AS rows FROM l WHERE t <> '' GROUP BY doc_id)
    SELECT doc_id, round(rows, 4) AS rows, round(CASE WHEN rows > 47 THEN 47 / rows ELSE 1 END, 6) AS scale FROM r""")
def fit_scale(spark, sf):
    """What each document's lines are shrunk by, as paragraphs and headings of one page."""
    lines = tables.text_lines(table(spark, sf, "documents").where("text is not null"), "doc_id", "text").withColumn("text", scalar.strip(F.col("text"))).where("text <> ''")
    kind = F.when(F.startswith("text", F.lit("#")), "heading").otherwise("para")
    parts = lines.select("doc_id", "text", kind.alias("kind"), F.lit(None).cast("array<struct<kind:string,cells:array<string>>>").alias("t_items"))
    return pages.fit_scale(parts, ["doc_id"]).select("doc_id", F.round("rows", 4).alias("rows"), F.round("scale", 6).alias("scale"))


@query()
def similar_names(spark, sf):
    """Ratcliff/Obershelp similarity of part names that share a fuzzy pair; SQL cannot express it."""
    n = table(spark, sf, "part").select(F.lower("p_name").alias("key"))
    return fuzzy.fuzzy_pairs(n, 3, 0.5).select("x", "y", F.round(fuzzy.similarity("x", "y"), 6).alias("similarity")).where("similarity >= 0.7")


@query(f"""WITH RECURSIVE l AS ({SQL_LEGS}),
      c AS (SELECT l.user_id, l.event_id AS seq, list_distinct([epoch_us(e.ts) // 86400000000, (epoch_us(e.ts) + x * 1000000) // 86400000000]) AS cells, row_number() OVER (PARTITION BY l.user_id ORDER BY l.event_id) AS i FROM l JOIN events e USING (event_id)),
      w AS (SELECT user_id, i, seq, cells, seq AS cluster, map(cells, list_transform(cells, lambda c: seq)) AS owner FROM c WHERE i = 1
            UNION ALL
            SELECT user_id, i, seq, cells, cluster, map_concat(owner, map(cells, list_transform(cells, lambda c: cluster))) FROM (
                SELECT c.user_id, c.i, c.seq, c.cells, w.owner, coalesce(list_filter(list_transform(c.cells, lambda x: w.owner[x]), lambda x: x IS NOT NULL)[1], c.seq) AS cluster
                FROM w JOIN c ON c.user_id = w.user_id AND c.i = w.i + 1))
    SELECT user_id, min(seq) AS first_seq, count(*) AS n_findings, array_to_string(list_sort(list_distinct(flatten(list(cells)))), ',') AS cells FROM w GROUP BY user_id, cluster""")
def collapse(spark, sf):
    """Findings on a user's legs that own the days of their ends, as clusters in order of emission."""
    day = lambda t: F.expr(f"({t}) div 86400000000")
    f = _legs(spark, sf).select("user_id", F.col("event_id").alias("seq"), F.array_distinct(F.array(day("us"), day("us + dt * 1000000"))).alias("cells"))
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_set("cells"))))
    out = findings.collapse(f, ["user_id"], "seq", "cells", first_seq=F.min("seq"), n_findings=F.count("*"), every=every)
    return out.select("user_id", "first_seq", "n_findings", F.array_join(F.col("every").cast("array<string>"), ",").alias("cells"))


@query(r"""SELECT conv_id, turn, replace(regexp_replace(replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'), '^{}[]', ''), '\\([*_])', '\1', 'g'), chr(10), '<br>') AS html FROM conversations""")
def escape_html(spark, sf):
    """Texts escaped for HTML."""
    return table(spark, sf, "conversations").select("conv_id", "turn", scalar.escape_html(F.col("text")).alias("html"))


@query("""WITH c AS (SELECT DISTINCT user_id AS k, event_id AS r, length(event_type) AS c FROM events WHERE event_type IS NOT NULL),
      g AS (SELECT *, r - row_number() OVER (PARTITION BY k, c ORDER BY r) AS g FROM c),
      n AS (SELECT k, c, min(r) AS a, max(r) AS b FROM g GROUP BY k, c, g)
    SELECT k, string_agg('r' || a || CASE WHEN b > a THEN '–' || b ELSE '' END || 'c' || c, ' ' ORDER BY a, c, b) AS ranges FROM n GROUP BY k""")
def cell_ranges(spark, sf):
    """A user's events as ranges of rows in a column of their type."""
    ev = table(spark, sf, "events").where("event_type is not null").select(F.col("user_id").alias("k"), F.col("event_id").alias("r"), F.length("event_type").alias("c"))
    return sinks.cell_ranges(ev, ["k"], "r", "c")


@query("""WITH n AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) ELSE '' END AS t FROM events),
      g AS (SELECT *, sum(CASE WHEN t <> '' OR i = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) AS g FROM n)
    SELECT user_id, CAST(min(i) AS BIGINT) AS first, count(*) AS colspan, max(t) AS text FROM g GROUP BY user_id, g""")
def head_spans(spark, sf):
    """Head cells with the empty ones that continue them."""
    w = sequence.along(["user_id"], ["ts", "event_id"])
    ev = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type").withColumn("i", F.row_number().over(w).cast("bigint"))
    ev = ev.withColumn("t", F.when(F.col("event_type") == "signup", F.col("event_id").cast("string")).otherwise(""))
    return sinks.head_spans(ev, ["user_id"], "i", "t")


@query("""SELECT lower(p_name) AS name, count(*) AS n, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS places FROM part GROUP BY 1""")
def name_occurrences(spark, sf):
    """How often and under which brands a name is printed."""
    o = names.occurrences(table(spark, sf, "part").select(F.lower("p_name").alias("name"), "p_brand"), "name", "p_brand")
    return o.select("name", "n", F.array_join("places", ",").alias("places"))


@query("""WITH f AS (SELECT user_id, epoch_us(ts) // 86400000000 AS a, epoch_us(ts) // 86400000000 + event_id % 2 AS b, event_id FROM events WHERE event_type = 'error'),
      n AS (SELECT *, CASE WHEN a <= lag(b) OVER w + 1 THEN 0 ELSE 1 END AS n FROM f WINDOW w AS (PARTITION BY user_id ORDER BY a, b, event_id)),
      g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY a, b, event_id ROWS UNBOUNDED PRECEDING) AS g FROM n)
    SELECT user_id, min(a) AS first, max(b) AS last, count(*) AS size FROM g GROUP BY user_id, g HAVING count(*) >= 3""")
def misaligned_runs(spark, sf):
    """Three errors of a user or more on adjoining days."""
    day = F.floor(micros() / 86_400_000_000)
    ev = table(spark, sf, "events").where("event_type = 'error'").select("user_id", "event_id", day.alias("a"), (day + F.col("event_id") % 2).alias("b"))
    return findings.merge_runs(ev, ["user_id"], "a", "b", ties=["event_id"])


@query(f"""WITH s AS ({SQL_NAMES}),
      n AS (SELECT DISTINCT 'number' AS why, f.p_name || ' #' AS x, f.p_name || ' ' || {ROMAN_SQL}[g.r] AS y FROM s f JOIN s g ON f.p_name = g.p_name AND f.v = g.r
            UNION SELECT 'abbreviation', left(f.a, 2) || '. ' || f.b || ' #', g.p_name || ' #' FROM s f JOIN s g ON f.b = g.b AND left(f.a, 2) = left(g.a, 2)
            UNION SELECT 'abbreviation', left(f.a, 1) || '/' || f.b, g.p_name FROM s f JOIN s g ON f.b = g.b AND left(f.a, 1) = left(g.a, 1) WHERE false)
    SELECT why, least(x, y) AS x, greatest(x, y) AS y FROM n""")
def notation_pairs(spark, sf):
    """Shapes of names that differ in notation only."""
    return names.notation_links(_part_names(spark, sf), "name")


SQL_PAGES = """SELECT p_partkey // 100 AS page, p_partkey AS pos, p_partkey % 50 = 0 AS band,
           CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 < 2 THEN p_partkey % 90 || ' км' ELSE p_name END AS name,
           CASE WHEN p_partkey % 5 < 2 THEN '' ELSE CAST(p_size AS VARCHAR) END AS d, CASE WHEN p_partkey % 13 = 0 THEN '—' ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS p FROM part"""


@query(f"""WITH RECURSIVE a AS ({SQL_PAGES}),
      b AS (SELECT *, 2 * sum(CAST(band AS BIGINT)) OVER (PARTITION BY page ORDER BY pos) - CAST(band AS BIGINT) AS seg, NOT band AND regexp_matches(name, '^[0-9]+\\s*км$') AS post, d NOT IN ('', '—', '-') AS has_d, p NOT IN ('', '—', '-') AS has_p FROM a),
      c AS (SELECT *, post AND coalesce(last_value(CASE WHEN NOT band AND name <> '' AND NOT post THEN seg END IGNORE NULLS) OVER (PARTITION BY page ORDER BY pos ROWS UNBOUNDED PRECEDING) = seg, false) AS cont FROM b),
      l AS (SELECT *, NOT band AND name <> '' AND NOT cont AS starts, cont AND NOT (has_d AND has_p) AS loose FROM c),
      m AS (SELECT *, sum(CAST(starts AS BIGINT)) OVER w AS nth, sum(CAST(NOT band AND NOT loose AS BIGINT)) OVER w AS at_ FROM l WINDOW w AS (PARTITION BY page ORDER BY pos)),
      names AS (SELECT page, seg, nth, string_agg(name, ' ' ORDER BY pos) AS name FROM m WHERE starts OR cont GROUP BY ALL),
      seen AS (SELECT *, row_number() OVER (PARTITION BY page, name ORDER BY nth) = 1 AS first FROM names),
      r AS (SELECT *, row_number() OVER (PARTITION BY page, at_ ORDER BY pos) - 1 AS r FROM m WHERE NOT band),
      f AS (SELECT page, seg, at_, r, pos, d, p, '' AS what, '' AS detail FROM r WHERE r = 0
            UNION ALL
            SELECT page, seg, at_, r, pos, CASE WHEN NOT clash AND new_d THEN y ELSE d END, CASE WHEN NOT clash AND new_p THEN z ELSE p END,
                   CASE WHEN clash THEN 'DROPPED cells' WHEN new_d OR new_p THEN 'recovered cells' ELSE '' END,
                   CASE WHEN clash THEN 'no distance, they contradict the row above: ' || concat_ws(', ', CASE WHEN bad_d THEN 'col 1: ⟨' || d || '⟩ vs ⟨' || y || '⟩' END, CASE WHEN bad_p THEN 'col 2: ⟨' || p || '⟩ vs ⟨' || z || '⟩' END)
                        ELSE concat_ws(', ', CASE WHEN new_d THEN 'col 1' END, CASE WHEN new_p THEN 'col 2' END) || ' from cells with no distance of their own' END
            FROM (SELECT *, bad_d OR bad_p AS clash FROM (
                SELECT f.page, f.seg, f.at_, r.r, r.pos, f.d, f.p, r.d AS y, r.p AS z, r.has_d AND f.d IN ('', '—', '-') AS new_d, r.has_p AND f.p IN ('', '—', '-') AS new_p,
                       r.has_d AND f.d NOT IN ('', '—', '-', r.d) AS bad_d, r.has_p AND f.p NOT IN ('', '—', '-', r.p) AS bad_p
                FROM f JOIN r ON r.page = f.page AND r.at_ = f.at_ AND r.r = f.r + 1))),
      filled AS (SELECT page, seg, at_, max_by(d, r) AS d, max_by(p, r) AS p FROM f GROUP BY ALL),
      v AS (SELECT * FROM (SELECT *, max(CASE WHEN d NOT IN ('', '—', '-') OR p NOT IN ('', '—', '-') THEN at_ END) OVER (PARTITION BY page, seg) AS last FROM filled) WHERE at_ <= last),
      x AS (SELECT page, seg, name, row_number() OVER (PARTITION BY page, seg ORDER BY nth) AS i FROM seen WHERE first),
      y AS (SELECT page, seg, d, p, row_number() OVER (PARTITION BY page, seg ORDER BY at_) AS i FROM v),
      t AS (SELECT page, seg, i, 'row' AS kind, coalesce(name, '') || '|' || coalesce(d, '') || '|' || coalesce(p, '') AS cells FROM x FULL JOIN y USING (page, seg, i)
            UNION ALL SELECT page, seg, 0, 'band', name || '|' || d || '|' || p FROM m WHERE band),
      n AS (SELECT page, seg, (SELECT count(*) FROM x WHERE x.page = s.page AND x.seg = s.seg) AS n, (SELECT count(*) FROM y WHERE y.page = s.page AND y.seg = s.seg) AS m FROM (SELECT DISTINCT page, seg FROM m WHERE NOT band) s),
      told AS (SELECT q.page, 0 AS o, q.pos AS a, 0 AS b, 'joined wrapped name' AS what, '⟨' || (SELECT string_agg(z.name, ' ' ORDER BY z.pos) FROM m z WHERE z.page = q.page AND z.nth = q.nth AND z.pos <= q.pos AND (z.starts OR z.cont)) || '⟩' AS detail FROM m q WHERE cont
               UNION ALL SELECT page, 0, pos, 1, what, detail FROM f WHERE what <> ''
               UNION ALL SELECT page, 1, seg, nth, 'dropped a re-read name', '⟨' || name || '⟩ -- the OCR read part of the station column twice' FROM seen WHERE NOT first
               UNION ALL SELECT page, 1, seg, 1000000000, 'names and rows differ', n || ' station name(s) against ' || m || ' row(s) of times; the tail of the shorter column is missing from the scan' FROM n WHERE n <> m)
    SELECT page, row_number() OVER (PARTITION BY page ORDER BY seg, i) - 1 AS pos, kind, cells, NULL AS what, NULL AS detail FROM t
    UNION ALL SELECT page, row_number() OVER (PARTITION BY page ORDER BY o, a, b) - 1, 'problem', '', what, detail FROM told""")
def realigned_pages(spark, sf):
    """Names and values of the parts, a hundred a page, zipped again after some names are lost, broken over lines or read twice."""
    k = F.col("p_partkey")
    name = F.when(k % 7 == 0, "").when(k % 11 < 2, F.concat((k % 90).cast("string"), F.lit(" км"))).otherwise(F.col("p_name"))
    cells = F.array(name, F.when(k % 5 < 2, "").otherwise(F.col("p_size").cast("string")), F.when(k % 13 == 0, "—").otherwise(F.floor("p_retailprice").cast("string")))
    pages = table(spark, sf, "part").select(F.expr("p_partkey div 100").alias("page"), k.alias("pos"), (k % 50 == 0).alias("band"), cells.alias("cells"))
    out = realign.realign(pages, ["page"], 0, 1)
    return out.select("page", "pos", "kind", F.array_join("cells", "|").alias("cells"), "what", "detail")


@query("""SELECT l_orderkey AS r, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, 'part ' || l_partkey AS name, CAST(l_suppkey AS VARCHAR) AS key FROM lineitem""")
def table_round_trip(spark, sf):
    """Each order's lines as a table in text, with a head and a band, and read again."""
    row = lambda kind, *cells: F.struct(F.lit(kind).alias("kind"), F.array(*cells).alias("cells"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("r"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("x"))
    made = li.groupBy("r").agg(F.array_sort(F.collect_list("x")).alias("x"))
    body = F.transform("x", lambda x: row("row", F.concat(F.lit("part "), x["l_partkey"].cast("string")), x["l_suppkey"].cast("string")))
    made = made.withColumn("rows", F.concat(F.array(row("head", F.lit("name"), F.lit("key")), row("band", F.lit("a band over the whole table"), F.lit(""))), body))
    text = tables.table_text(made.withColumns({"w": F.lit(2), "h": F.lit(1)}), "rows", "w", "h", "t").select("r", "t")
    read = tables.read_book_table(text, "t").select("r", F.filter("t_items", lambda i: i["kind"] == "row").alias("items"))
    return read.select("r", F.posexplode("items").alias("i", "x")).select("r", (F.col("i") + 1).cast("bigint").alias("i"), F.col("x.cells")[0].alias("name"), F.col("x.cells")[1].alias("key"))


def _nation_tables(spark, sf):
    """(r, x): a nation's suppliers as rows of a table, in the order of their keys."""
    n = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("r"), F.struct(F.col("s_suppkey").alias("k"), F.col("s_name").alias("n")).alias("x"))
    return n.groupBy("r").agg(F.array_sort(F.collect_list("x")).alias("x"))


@query("""WITH v AS (SELECT s_nationkey + 1 AS scan, s_suppkey AS k, s_name AS name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) + 1 AS i, s_suppkey % 3 AS odd, s_suppkey % 2 = 0 AS differ FROM supplier)
    SELECT scan, '7' AS page, 'table 1, row ' || i || ' col 1 · ' || CASE WHEN odd = 0 THEN lower(name) ELSE name END AS place,
           name || ' (' || CASE odd WHEN 0 THEN 'b, c' WHEN 1 THEN 'a, c' ELSE 'a, b' END || '); ' || lower(name) || ' (' || ['a', 'b', 'c'][odd + 1] || ')' AS readings FROM v WHERE differ AND name <> lower(name)""")
def merged_runs(spark, sf):
    """Three runs of scan files, one table a nation, in which each second supplier is read differently by one run: the disputes of their merge."""
    row = lambda kind, *cells: F.struct(F.lit(kind).alias("kind"), F.array(*cells).alias("cells"))
    runs_ = _nation_tables(spark, sf).withColumn("ord", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    name = lambda x: F.when((x["k"] % 2 == 0) & (x["k"] % 3 == F.col("ord")), F.lower(x["n"])).otherwise(x["n"])
    made = runs_.withColumn("rows", F.concat(F.array(row("head", F.lit("name"), F.lit("key"))), F.transform("x", lambda x: row("row", name(x), x["k"].cast("string"))))).withColumns({"w": F.lit(2), "h": F.lit(1)})
    text = tables.table_text(made, "rows", "w", "h", "t")
    whole = F.concat(F.lit("---\nscan: "), (F.col("r") + 1).cast("string"), F.lit("\nkind: cover\nfolios: [7]\nshapes: [suburban]\n---\n\n## page 7\n\n"), F.col("t"), F.lit("\n"))
    files = text.select(F.concat(F.lit("scan-"), F.col("r").cast("string"), F.lit(".md")).alias("file"), whole.alias("text"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.col("ord") + 1).alias("run"), "ord", F.lit(False).alias("extra"))
    return merge.merge_runs(files)[1].select("scan", "page", F.col("where").alias("place"), "readings")


@query("""WITH f AS (SELECT event_id, user_id, event_type, floor(value) AS v FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL),
      k AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN event_type = 'error' THEN 0 ELSE 1 END, v DESC, user_id, event_type, event_id) AS n FROM f),
      c AS (SELECT n, CAST(n AS VARCHAR) AS c0, CASE WHEN event_type = 'error' THEN 'IMPOSSIBLE' ELSE 'deviation' END AS c1, CAST(user_id AS VARCHAR) AS c2, event_type AS c5, 'r' || event_id || 'c1' AS c7, 'value ' || CAST(v AS BIGINT) AS c9, 'n=' || CAST(v AS BIGINT) AS c10 FROM k),
      w AS (SELECT max(length(c0)) AS w0, greatest(5, max(length(c1))) AS w1, greatest(4, max(length(c2))) AS w2, greatest(5, max(length(c5))) AS w5, greatest(5, max(length(c7))) AS w7, greatest(7, max(length(c9))) AS w9, greatest(8, max(length(c10))) AS w10 FROM c)
    SELECT n, '| ' || rpad(c0, CAST(w0 AS INT), ' ') || ' | ' || rpad(c1, CAST(w1 AS INT), ' ') || ' | ' || rpad(c2, CAST(w2 AS INT), ' ') || ' |       | x     | ' || rpad(c5, CAST(w5 AS INT), ' ') || ' | at    | '
           || rpad(c7, CAST(w7 AS INT), ' ') || ' | structure | ' || rpad(c9, CAST(w9 AS INT), ' ') || ' | ' || rpad(c10, CAST(w10 AS INT), ' ') || ' |' AS line FROM c, w""")
def findings_text(spark, sf):
    """Findings in rank order as the lines of a report."""
    v = F.floor("value")
    ev = table(spark, sf, "events").where("value is not null and event_type is not null")
    found = ev.select(
        F.col("user_id").cast("int").alias("scan"), F.lit(None).cast("int").alias("folio"), F.lit("x").alias("shape"), F.col("event_type").alias("train"), F.array(F.lit(0)).alias("rules"), F.when(F.col("event_type") == "error", 0).otherwise(1).alias("severity"),
        v.cast("double").alias("weighted"), F.lit("at").alias("station"), F.array(F.struct(F.col("event_id").cast("int").alias("r"), F.lit(1).alias("c"))).alias("cells"), F.col("event_id").alias("first"),
        F.concat(F.lit("value "), v.cast("string")).alias("message"), F.array(F.struct(F.lit("n").alias("k"), v.cast("string").alias("v"))).alias("evidence"),
    )
    return timetable.findings_lines(found).where("n > 0")


#: Golden notations, as a list made by hand: any text and a number at different places, and one without any text of its own.
GOLDEN = ["small …", "… gear", "…ol…", "red widget", "# …", "…", "nothing …", "… b…"]


@query("""WITH n AS (SELECT DISTINCT p_name AS name FROM part WHERE p_name IS NOT NULL),
      p AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS id, unnest(['^small .*$', '^.* gear$', '^.*ol.*$', '^red widget$', '^[0-9,]+ .*$', '^.*$', '^nothing .*$', '^.* b.*$']) AS regex)
    SELECT id, count(*) AS n, min(name) AS first, max(name) AS last FROM p JOIN n ON regexp_matches(name, regex) GROUP BY id""")
def matched_patterns(spark, sf):
    """How many names each golden notation matches, by the rarest stretch of its own text."""
    own = table(spark, sf, "part").where("p_name is not null").select(F.col("p_name").alias("name")).distinct()
    return names.match_patterns(own, list(enumerate(GOLDEN))).groupBy("id").agg(F.count("*").alias("n"), F.min("name").alias("first"), F.max("name").alias("last"))


@query(f"""WITH s AS ({SQL_NAMES}),
      p AS (SELECT DISTINCT 'end Roman number' AS grp, '… I…' AS printed, p_name || ' ' || {ROMAN_SQL}[r] AS name FROM s
            UNION SELECT 'front ' || left(a, 2), left(a, 2) || '. …', left(a, 2) || '. ' || b || ' ' || v FROM s
            UNION SELECT 'front ' || left(a, 1), left(a, 1) || '/…', left(a, 1) || '/' || b FROM s)
    SELECT grp, printed, name, CAST(count(*) OVER (PARTITION BY grp) - count(*) OVER (PARTITION BY grp, printed) AS BIGINT) AS n_against FROM p""")
def set_against(spark, sf):
    """How many names are set against each name that a notation part groups."""
    parts = names.notation_parts(_part_names(spark, sf), "name").select(F.concat_ws(" ", "place", "key").alias("group"), "printed", "name")
    return names.set_against(parts).withColumnRenamed("group", "grp")


@query("""SELECT l_orderkey, min(l_quantity) AS x0, min(l_extendedprice) AS y0, max(l_quantity) AS x1, max(l_extendedprice) AS y1 FROM lineitem GROUP BY l_orderkey""")
def extents(spark, sf):
    """The box round an order's lines by quantity and price."""
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return ocr.extents(table(spark, sf, "lineitem").select("l_orderkey", q.alias("x0"), q.alias("x1"), p.alias("y0"), p.alias("y1")), ["l_orderkey"])


@query("""WITH f AS (SELECT row_number() OVER (ORDER BY conv_id, turn, text) AS n, CAST(conv_id AS VARCHAR) AS a, coalesce(role, '') AS b, coalesce(text, '') AS c FROM conversations),
      w AS (SELECT greatest(4, max(length(a))) AS wa, greatest(4, max(length(b))) AS wb, greatest(4, max(length(c))) AS wc FROM f)
    SELECT n, '| ' || a || repeat(' ', wa - length(a)) || ' | ' || b || repeat(' ', wb - length(b)) || ' | ' || c || repeat(' ', wc - length(c)) || ' |' AS line FROM f, w
    UNION ALL SELECT -1, '| conv' || repeat(' ', wa - 4) || ' | role' || repeat(' ', wb - 4) || ' | text' || repeat(' ', wc - 4) || ' |' FROM w
    UNION ALL SELECT 0, '|' || repeat('=', wa + 2) || '|' || repeat('=', wb + 2) || '|' || repeat('=', wc + 2) || '|' FROM w""")
def report_text(spark, sf):
    """The turns of all conversations as the lines of one aligned report."""
    return report.report_lines(table(spark, sf, "conversations"), ["conv_id", "turn", "text"], ["conv", "role", "text"], ["conv_id", "role", "text"])


@query("""SELECT doc_id, CAST(unnest(range(1, len(t) + 1)) AS BIGINT) AS line, md5(unnest(t)) AS md5 FROM (SELECT doc_id, CASE WHEN ends_with(text, chr(10)) THEN string_split(text[:-2], chr(10)) ELSE string_split(text, chr(10)) END AS t FROM documents WHERE text <> '')""")
def files_round_trip(spark, sf):
    """Every document written as a file of its own by the executors and read again by them as numbered lines."""
    docs = table(spark, sf, "documents").where("text <> ''").select("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"), "text")
    folder = f"{shared_dir(spark)}/texts-{uuid.uuid4().hex}"
    sinks.write_texts(docs, folder, spread=True)
    lines = runs.read_spread_lines(spark, folder)
    return lines.select(F.regexp_extract("file", r"\Adoc-(-?\d+)\.txt\z", 1).cast("bigint").alias("doc_id"), F.col("line").cast("bigint").alias("line"), F.md5(F.col("t").cast("binary")).alias("md5"))
