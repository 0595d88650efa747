"""Checking a timetable against itself: the operators bound to train columns of book pages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions import scalar
from tidegauge.operators import consistency, findings, fuzzy, sequence, stats
from tidegauge.operators.report import numbered_lines
from tidegauge.sources import scanfiles, sinks
from tidegauge.sources.shared import stage

# Words of table heads, page shapes with (station column, columns that hold no times), and the lines'
# reckonings with the kilometres they are printed in.
HEADER_WORDS = ["приб.", "отпр.", "прибытие", "отправление", "разд. пункты", "раздельные пункты", "№ поездов", "расстояние км", "расстояние"]
SHAPES = {"suburban": (0, (0,)), "two-way": (2, (2,)), "distance": (0, (0, 1))}
RECKONINGS = [("moscow", 600.0, 930.0), ("daugavpils", 250.0, 600.0), ("riga", 0.0, 250.0)]
MILEPOSTING = {
    "Себеж": ["moscow"], "Даугавпилс": ["moscow", "daugavpils"], "Бигосово": ["moscow", "daugavpils"], "Пыталово": ["moscow", "riga"],
    "Лиепая": ["riga"], "Валга": ["riga"], "Вентспилс": ["riga"], "Пярну": ["riga"],
}
NUMBERS = r"№\s*([\d/]+\*{0,2}(?:\s*[А-ЯЁ]{1,2}\b)?)"
ROUTE = r"([А-ЯЁа-яё\-\. ]+)—([А-ЯЁа-яё\-\. ]+)"
HOME = "Рига"
# When a step back may be midnight, in seconds, and the texts of findings on heads inside tables.
EVENING, MORNING, WRAP_DWELL = 20 * 3600, 8 * 3600, 3600
REPEATED = "header inside the table, naming the same trains as the head — the OCR read the top of the table twice; delete the repeat"
GLUED = "header inside the table and the station list starts again under it — two tables glued into one; split them, each with its own head rule"
INNER = "header inside the table — repeated by the OCR, or a table glued on; check the scan"


@dataclass(frozen=True)
class Config:
    """Thresholds of the rules."""

    max_kmh: float = 120.0
    z: float = 3.5
    leg_ratio: float = 1.5
    dwell_ratio: float = 2.0
    min_samples: int = 5
    leg_min_diff: int = 60
    dwell_min_diff: int = 120
    similar: float = 0.7
    max_leg_km: float = 60.0
    run: int = 3
    skip: tuple = field(default=("prose",))


TABLE = ["scan", "half", "folio", "shape", "item"]
COLUMN = [*TABLE, "seg", "pair"]
TEXTS, EVIDENCE = "array<struct<r:int,c:int,t:string>>", "array<struct<k:string,v:string>>"


def column_pairs(shape, width):
    """A table's column pairs as an array of (pair, a, b): runs of columns between those without times, cut in twos; a lone last one has no b."""
    out = None
    for name, (_, protected) in SHAPES.items():
        edges = sorted({-1, *protected})
        runs_ = [(a + 1, F.lit(b)) for a, b in zip(edges, edges[1:]) if b > a + 1] + [(edges[-1] + 1, width)]
        cut = F.flatten(F.array(*[F.when(F.least(e, width) > s, F.transform(F.sequence(F.lit(s), F.greatest(F.least(e, width) - 1, F.lit(s)), F.lit(2)), _two(F.least(e, width)))).otherwise(F.array().cast("array<struct<a:int,b:int>>")) for s, e in runs_]))
        own = F.transform(cut, lambda p, i: F.struct(i.alias("pair"), p["a"].alias("a"), p["b"].alias("b")))
        out = F.when(shape == name, own) if out is None else out.when(shape == name, own)
    return out


def _two(end):
    return lambda a: F.struct(a.alias("a"), F.when(a + 1 < end, a + 1).alias("b"))


def _cell(cells, at):
    return F.coalesce(F.try_element_at(cells, (at + 1).cast("int")), F.lit(""))


def _named(cells):
    """Positions and texts of head cells that are no head words."""
    indexed = F.transform(cells, lambda c, i: F.struct(i.alias("i"), c.alias("t")))
    return F.filter(indexed, lambda s: (s["t"] != "") & ~F.lower(s["t"]).isin(HEADER_WORDS))


def _name_at(head, at):
    return F.filter(head, lambda s: s["i"] == at)


def read_columns(spark: SparkSession, path: str, config: Config) -> dict[str, DataFrame]:
    """Frames of the pages: stops, zones' rows, heads inside tables and pages without rules."""
    items = stage(scanfiles.page_items(scanfiles.read_scan_files(spark, path)), "items")
    pages = items.select("scan", "half", "folio", "shape").distinct()
    rows = scanfiles.table_rows(items.where(F.col("shape").isin(list(SHAPES))))
    station_col = F.when(F.col("shape") == "two-way", 2).otherwise(0)
    rows = rows.where((F.col("width") > station_col) & F.col("kind").isin("head", "row")).withColumn("sc", station_col)
    whole = Window.partitionBy(*TABLE)
    # the table's head: the first text of each column
    heads = rows.where("kind = 'head'").select(*TABLE, "line", F.explode(_named(F.col("cells"))).alias("n"))
    heads = heads.groupBy(*TABLE, F.col("n.i").alias("i")).agg(F.min_by("n.t", "line").alias("t"))
    heads = heads.groupBy(*TABLE).agg(F.array_sort(F.collect_list(F.struct("i", "t"))).alias("head"))
    body = rows.where("kind = 'row'").withColumn("ri", F.row_number().over(whole.orderBy("line")) - 1)
    low = F.transform("cells", lambda c: F.lower(c))
    body = body.withColumn("inner", F.coalesce(F.try_element_at(low, (F.col("sc") + 1).cast("int")).isin(HEADER_WORDS), F.lit(False)) | (F.size(F.filter(low, lambda c: c.isin(HEADER_WORDS))) >= 2))
    run = whole.orderBy("ri")
    first_of_run = ~F.col("inner") & F.coalesce(F.lag("inner").over(run), F.lit(True))
    body = body.withColumn("seg", F.sum(first_of_run.cast("int")).over(run) - 1)  # a head row has the number of the segment before it
    body = stage(body, "body")
    # heads inside the body: runs of them, and the names they give the segment below
    inner = body.where("inner")
    runs = inner.where("seg >= 0").groupBy(*TABLE, "sc", F.col("seg").alias("above"), "width").agg(
        F.min("ri").alias("a"), F.max("ri").alias("b"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ri", _named(F.col("cells")).alias("n")))), lambda s: s["n"])).alias("names")
    )
    over = inner.select(*TABLE, (F.col("seg") + 1).alias("seg"), "ri", F.explode(_named(F.col("cells"))).alias("n"))
    over = over.groupBy(*TABLE, "seg", F.col("n.i").alias("i")).agg(F.max_by("n.t", "ri").alias("t"))
    over = over.groupBy(*TABLE, "seg").agg(F.array_sort(F.collect_list(F.struct("i", "t"))).alias("over"))
    seg = body.where("not inner").withColumn("row", F.row_number().over(Window.partitionBy(*TABLE, "seg").orderBy("ri")) - 1)
    seg = seg.withColumn("n_seg", F.max("seg").over(whole) + 1)
    empty = F.array().cast("array<struct<i:int,t:string>>")
    seg = _join(seg, heads, TABLE)
    seg = _join(seg, over, [*TABLE, "seg"])
    both = F.concat(F.coalesce("over", empty), F.filter(F.coalesce("head", empty), lambda h: ~F.exists(F.coalesce(F.col("over"), empty), lambda o: o["i"] == h["i"])))
    seg = seg.withColumn("names", both)
    km = F.when(F.col("shape") == "distance", scalar.km_tenths(_cell(F.col("cells"), F.lit(1))) / 10.0)
    seg = stage(seg.withColumn("station", _cell(F.col("cells"), F.col("sc"))).withColumn("km", km), "segments")

    caps = items.where("kind = 'caption'").groupBy("scan", "half", "item").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda s: s["text"]), "\n").alias("t"))
    numbers = F.transform(F.regexp_extract_all("t", F.lit(NUMBERS), F.lit(1)), lambda n: scalar.strip(n))
    captions = caps.groupBy("scan", "half").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("item", numbers.alias("n")))), lambda s: s["n"])).alias("found"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("item", F.split("t", "[·\n]").alias("p")))), lambda s: s["p"])).alias("parts"),
    )
    ends = F.transform(F.filter("parts", lambda p: p.rlike(ROUTE)), lambda p: F.array(*[F.regexp_replace(F.regexp_extract(p, ROUTE, g), r"\A[ .]+|[ .]+\z", "") for g in (1, 2)]))
    far = F.filter(F.transform(ends, lambda e: F.filter(e, lambda x: ~F.startswith(x, F.lit(HOME)))), lambda e: F.size(e) == 1)
    captions = captions.select("scan", "half", "found", F.try_element_at(far, F.lit(1))[0].alias("destination"))

    # unpivot: a table's column pairs follow from its shape and width
    stops = seg.withColumn("p", F.explode(column_pairs(F.col("shape"), F.col("width")))).select(*seg.columns, "p.*").join(captions, ["scan", "half"], "left")
    n_pairs = F.count("*").over(Window.partitionBy(*TABLE, "seg", "row"))
    stops = stops.withColumn("n_pairs", n_pairs)
    named = F.coalesce(F.try_element_at(_name_at(F.col("names"), F.col("a")), F.lit(1))["t"], F.try_element_at(_name_at(F.col("names"), F.col("b")), F.lit(1))["t"])
    any_named = F.max(named.isNotNull()).over(Window.partitionBy(*TABLE, "seg"))
    name = (
        F.when((F.col("shape") == "suburban") & any_named, F.coalesce(named, F.lit("?")))
        .when(F.size(F.coalesce("found", F.array().cast("array<string>"))) == F.col("n_pairs"), F.try_element_at("found", (F.col("pair") + 1).cast("int")))
        .otherwise(F.concat(F.lit("?"), F.col("item").cast("string"), F.lit("."), (F.col("pair") + 1).cast("string")))
    )
    label = F.concat(name, F.when(F.col("n_seg") > 1, F.concat(F.lit(" (part "), (F.col("seg") + 1).cast("string"), F.lit(")"))).otherwise(""))
    stops = stops.withColumn("train", label).withColumn("arr", _cell(F.col("cells"), F.col("a"))).withColumn("dep", F.when(F.col("b").isNull(), "").otherwise(_cell(F.col("cells"), F.col("b"))))
    for side in ("arr", "dep"):
        stops = stops.withColumn(f"{side}_sec", scalar.time_seconds(F.col(side))).withColumn(f"{side}_kind", scalar.cell_kind(F.col(side)))
    stops = stops.withColumn("timed", F.col("arr_sec").isNotNull() | F.col("dep_sec").isNotNull())
    stops = stops.withColumn("_any", F.max("timed").over(Window.partitionBy(*COLUMN))).where("_any")
    keep = [*COLUMN, "train", "row", "station", "km", "a", "b", "arr", "dep", "arr_sec", "dep_sec", "arr_kind", "dep_kind", "timed"]
    return {"pages": pages, "runs": runs, "heads": heads, "segments": seg, "captions": captions, "stops": stage(stops.select(*keep), "stops")}


def _join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join with nulls equal (unnumbered pages have no folio)."""
    r = right.select(*[F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & (F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "folio" else F.col(c) == F.col(f"_{c}"))
    return left.join(r, cond, "left").drop(*[f"_{c}" for c in on])


def _cells(*pairs):
    """array of (r, c) structs."""
    return F.array(*[F.struct(r.cast("int").alias("r"), c.cast("int").alias("c")) for r, c in pairs])


def _text(*parts):
    """Parts joined to a message; null parts are left out."""
    return F.concat(*[F.coalesce(p.cast("string") if not isinstance(p, str) else F.lit(p), F.lit("")) for p in parts])


def _evidence(*pairs):
    return F.array(*[F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in pairs])


def _finding(df: DataFrame, rule, severity: int, score, station, cells, phase: int, order: list, message, evidence=None, texts=None) -> DataFrame:
    """Findings of df's rows; those of a train column get the printed texts of their cells later, others bring theirs."""
    own = [F.col(c).cast("int").alias(c) if c in df.columns else F.lit(None).cast("int").alias(c) for c in ("half", "item", "seg", "pair")]
    return df.select(
        "scan", "folio", "shape", "train", F.lit(rule).cast("int").alias("rule"), F.lit(severity).alias("severity"), score.cast("double").alias("score"), station.cast("string").alias("station"),
        cells.alias("cells"), F.lit(phase).alias("phase"), F.array(*[c.cast("bigint") for c in order]).alias("seq"), *own, message.alias("message"),
        (evidence if evidence is not None else F.array()).cast(EVIDENCE).alias("evidence"), (texts if texts is not None else F.array()).cast(TEXTS).alias("texts"),
    )


def _printed(cells, texts):
    """array of (r, c, t): cells and what they print."""
    return F.zip_with(cells, F.array(*texts), lambda p, t: F.struct(p["r"].alias("r"), p["c"].alias("c"), t.alias("t")))


def with_texts(found: DataFrame, stops: DataFrame) -> DataFrame:
    """found with the texts that its train column prints in its cells."""
    sides = F.array(F.struct(F.col("a").alias("c"), F.col("arr").alias("t")), F.struct(F.col("b").alias("c"), F.col("dep").alias("t")))
    at = ["scan", "half", "item", "seg", "pair", "r", "c"]
    printed = stops.select("scan", "half", "item", "seg", "pair", F.col("row").alias("r"), F.explode(sides).alias("x")).select(*at[:-1], "x.c", "x.t").where("c is not null")
    own = stage(found.withColumn("fid", F.monotonically_increasing_id()), "found")
    cells = own.where("pair is not null").select("fid", "scan", "half", "item", "seg", "pair", F.explode("cells").alias("x")).select("fid", *at[:-2], "x.r", "x.c")
    texts = cells.join(printed, at).groupBy("fid").agg(F.array_sort(F.array_distinct(F.collect_list(F.struct(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), "t")))).alias("own"))
    return own.join(texts, "fid", "left").withColumn("texts", F.coalesce("own", "texts").cast(TEXTS)).drop("own", "fid")


def _structure(spark: SparkSession, f: dict[str, DataFrame], config: Config) -> DataFrame:
    """Heads inside tables, and pages that no rules apply to."""
    runs = _join(f["runs"], f["heads"].withColumnRenamed("head", "table_head"), TABLE)
    name = F.coalesce(F.try_element_at(_name_at(F.col("names"), F.col("a2")), F.lit(1))["t"], F.try_element_at(_name_at(F.col("names"), F.col("b2")), F.lit(1))["t"])
    paired = runs.withColumn("p", F.explode(column_pairs(F.col("shape"), F.col("width")))).select(*runs.columns, "p.pair", F.col("p.a").alias("a2"), F.col("p.b").alias("b2"))
    named = paired.groupBy(*TABLE, "a", "b", "sc").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pair", name.alias("n")))), lambda s: s["n"]), ", ").alias("t")
    )
    named = named.withColumn("train", F.when(F.col("t") == "", "—").otherwise(F.col("t")))
    # what stands under it, and whether the table has listed that before
    seg = f["segments"].select(*TABLE, "seg", "row", scalar.strip(F.col("station")).alias("station"))
    under = seg.where("row = 0").select(*TABLE, (F.col("seg") - 1).alias("above"), F.col("station").alias("under"))
    lines = f["runs"].select(*TABLE, "a", "b", "above", "names").withColumn("rid", F.monotonically_increasing_id())
    lines = stage(_join(_join(lines, under, [*TABLE, "above"]), f["heads"], TABLE), "inner-heads")
    before = seg.select(*[F.col(c).alias(f"_{c}") for c in TABLE], F.col("seg").alias("_seg"), F.col("station").alias("_station"))
    on = F.col("_folio").eqNullSafe(F.col("folio")) & (F.col("_seg") <= F.col("above")) & (F.col("_station") == F.col("under"))
    for c in TABLE:
        on = on & (F.col(f"_{c}") == F.col(c)) if c != "folio" else on
    again = lines.where("under <> ''").join(before, on, "left_semi").select("rid", F.lit(True).alias("again"))
    # of the texts that several head rows give one column the last counts
    same = F.array_sort(F.map_entries(F.aggregate("names", F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<string>")), lambda m, n: F.map_concat(F.map_filter(m, lambda k, v: k != n["i"]), F.map_from_arrays(F.array(n["i"]), F.array(n["t"]))))))
    same = F.transform(same, lambda e: F.struct(e["key"].alias("i"), e["value"].alias("t")))
    kinds = lines.join(again, "rid", "left").select(*TABLE, "a", "b", "again", F.coalesce((F.size("names") > 0) & (same == F.col("head")), F.lit(False)).alias("repeat"))
    named = _join(named, kinds, [*TABLE, "a", "b"])
    message = F.when(F.col("repeat"), REPEATED).when(F.col("again"), GLUED).otherwise(INNER)
    rows = F.transform(F.sequence("a", "b"), lambda r: F.struct(r.cast("int").alias("r"), F.col("sc").cast("int").alias("c")))
    place = F.when(F.col("a") == F.col("b"), _text("row ", F.col("a"))).otherwise(_text("rows ", F.col("a"), "–", F.col("b")))
    z = F.lit(0)
    out = _finding(named, 0, 0, F.lit(10.0), place, rows, 0, [F.col("half"), F.col("item"), z, F.col("a")], message)
    odd = f["pages"].where(~F.col("shape").isin([*SHAPES, *config.skip])).withColumn("train", F.lit("—"))
    none = F.array().cast("array<struct<r:int,c:int>>")
    return out.unionByName(_finding(odd, 0, 0, F.lit(1.0), F.lit(None), none, 0, [F.col("half"), z, z, z], _text("shape ", scalar.cite(F.col("shape")), " — not checked, no rules apply to it")))


def _mileposts(spark: SparkSession, f: dict[str, DataFrame], config: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(zone of each row, findings on zones that no declared reckoning holds, mileposts of the others)."""
    seg = f["segments"].where("shape = 'distance'").select(*TABLE, "seg", "row", "station", "km", _cell(F.col("cells"), F.lit(1)).alias("km_text"))
    key = [*TABLE, "seg"]
    zoned = sequence.zones(seg, key, ["row"], "km", config.max_leg_km).select(*key, (F.col("pos") - 1).alias("row"), F.col("zone"))
    zoned = stage(_join(seg, zoned, [*key, "row"]), "zones").join(f["captions"].select("scan", "half", "destination"), ["scan", "half"], "left")
    bands = spark.createDataFrame(RECKONINGS, "name string, lo double, hi double")
    known = zoned.where("km is not null").groupBy(*key, "zone").agg(F.min("km").alias("k0"), F.max("km").alias("k1"))
    fit = known.join(F.broadcast(bands), (F.col("k0") >= F.col("lo")) & (F.col("k1") <= F.col("hi")), "left").groupBy(*key, "zone").agg(F.count("name").alias("n"), F.min("name").alias("name"))
    fit = fit.select(*key, "zone", F.when(F.col("n") == 1, F.col("name")).alias("reckoning"))
    rows = stage(_join(zoned, fit.withColumn("has_km", F.lit(True)), [*key, "zone"]), "reckonings")
    declared = spark.createDataFrame([(d, r) for d, r in MILEPOSTING.items()], "destination string, declared array<string>")
    rows = rows.join(F.broadcast(declared), "destination", "left").withColumn("train", F.lit("—"))
    bad = F.col("reckoning").isNull() | (F.col("declared").isNotNull() & ~F.array_contains(F.coalesce("declared", F.array().cast("array<string>")), F.col("reckoning")))
    rows = rows.withColumn("bad", F.coalesce(bad, F.lit(True)))
    ends = rows.where("bad and has_km").groupBy(*key, "zone", "train", "reckoning", "destination", "declared").agg(
        F.min("row").alias("r0"), F.max("row").alias("r1"), F.min_by("km_text", "row").alias("t0"), F.max_by("km_text", "row").alias("t1"), F.min("km").alias("k0"), F.max("km").alias("k1")
    )
    route = F.when(F.coalesce("destination", F.lit("")) != "", _text("route «", F.col("destination"), "»")).otherwise("route not printed")
    out_of = F.when(F.col("reckoning").isNull(), "no one reckoning").otherwise(_text("'", F.col("reckoning"), "', which ", route, " does not use"))
    message = _text("mileposts ", scalar.fixed_decimals(F.col("k0"), 1), "–", scalar.fixed_decimals(F.col("k1"), 1), " км fall in ", out_of, " — this zone is left out of rule 5")
    cells = _cells((F.col("r0"), F.lit(1)), (F.col("r1"), F.lit(1)))
    out = _finding(ends, 5, 0, F.lit(3.0), F.lit(None), cells, 0, [F.col("half"), F.col("item"), F.lit(1) + F.col("seg"), F.col("zone")], message, _evidence(("declared", F.coalesce(F.array_join("declared", ", "), F.lit("—")))), _printed(cells, [F.col("t0"), F.col("t1")]))
    posts = rows.where("not bad and km is not null and station <> ''")
    return rows.select(*key, "row", "zone"), out, posts


def _milepost_rule(posts: DataFrame, config: Config) -> DataFrame:
    """A milepost has one name on its reckoning, and a name one milepost."""
    seen = F.struct("scan", "half", "item", "seg", "row")
    posts = stage(posts.withColumn("seen", seen), "posts")
    cells = _cells((F.col("row"), F.lit(0)), (F.col("row"), F.lit(1)))
    out = []
    for i, (left, right) in enumerate(((["reckoning", "km"], "station"), (["reckoning", "station"], "km"))):
        odd = consistency.dependency_violations(posts.select("reckoning", "km", "station", "seen"), left, right, "seen")
        counts = posts.groupBy(*left, right).agg(F.count("*").alias("m"), F.min("seen").alias("s"))
        shown = counts.groupBy(*left).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", _text(F.col(right), "×", F.col("m")).alias("t")))), lambda x: x["t"]), ", ").alias("variants"))
        odd = odd.join(shown, left)
        if right == "station":
            odd = odd.where(fuzzy.similarity("station", "best") >= config.similar)
        hit = posts.join(odd.select(*left, right, F.col("score").alias("violation"), "best", "n_best", "variants"), [*left, right]).drop("pair")
        label = _text("milepost ", scalar.fixed_decimals(F.col("km"), 1), " км") if right == "station" else _text("station ", F.col("station"))
        message = _text(label, " is ", F.col(right), " here but ", F.col("best"), " on ", F.col("n_best"), " other ", F.col("reckoning"), " page(s)")
        order = [F.lit(i), (F.col("km") * 10).cast("bigint"), F.col("scan"), F.col("half"), F.col("row")]
        out.append(_finding(hit, 5, 0, F.col("violation"), F.col("station"), cells, 5, order, message, _evidence(("variants", F.col("variants"))), _printed(cells, [F.col("station"), F.col("km_text")])))
    return out[0].unionByName(out[1])


def check_columns(stops: DataFrame, zones: DataFrame, config: Config) -> dict[str, DataFrame]:
    """Findings of single columns, and the samples of legs, dwells and speeds."""
    col = [F.col(c) for c in ("half", "item", "seg", "pair")]
    at = lambda phase, *rest: [*col, F.lit(phase), *rest]
    found = []
    sides = stops.select(*COLUMN, "train", "row", "station", F.explode(F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("c"), F.col(s).alias("t"), F.col(f"{s}_kind").alias("kind"), F.col(f"{s}_sec").alias("sec")) for i, (s, c) in enumerate((("arr", "a"), ("dep", "b")))])).alias("x"))
    sides = sides.select(*COLUMN, "train", "row", "station", "x.side", "x.c", "x.t", "x.kind", "x.sec")
    bad = sides.where("kind = 'bad' and c is not null")
    found.append(_finding(bad, 0, 0, F.lit(10.0), F.col("station"), _cells((F.col("row"), F.col("c"))), 1, at(0, F.col("row"), F.col("side")), _text(scalar.cite(F.col("t")), " is not a time")))

    times = sides.where("sec is not null")
    fits = sequence.direction(times, COLUMN, ["row"], "sec", ["side"])
    timed = stops.where("timed").groupBy(*COLUMN, "train").agg(F.count("*").alias("n"), F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("a").alias("a"))
    fits = _join(timed, fits, COLUMN).withColumn("direction", F.when(F.col("n") < 2, 1).otherwise(F.col("direction")))
    fits = stage(fits, "directions")
    found.append(_finding(fits.where("direction is null"), 1, 0, 4.0 + F.col("down"), F.lit(None), _cells((F.col("r0"), F.col("a")), (F.col("r1"), F.col("a"))), 1, at(1, F.lit(0), F.lit(0)), _text("times fit neither direction (", F.col("down"), " backwards steps each way)")))

    way = fits.select(*COLUMN, F.when(F.col("direction") == -1, -1).otherwise(1).alias("way"))
    run = _join(times, way, COLUMN).withColumn("o", F.col("row") * F.col("way"))  # in the order of travel
    has_arr = F.max(F.when(F.col("side") == 0, True)).over(Window.partitionBy(*COLUMN, "row")).isNotNull()
    run = run.withColumn("at_stop", (F.col("side") == 1) & F.coalesce(has_arr, F.lit(False)))
    run = sequence.clock(run, COLUMN, ["o", "side"], "sec", F.col("at_stop"))
    so_far = sequence.along(COLUMN, ["o", "side"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = run.withColumn("prev", F.lag("v").over(sequence.along(COLUMN, ["o", "side"])))
    run = stage(run.withColumn("after", F.max(F.col("wrapped") | (F.col("sec") == sequence.DAY)).over(so_far)), "clocks")
    found.append(_back(run, at))
    cum = run.groupBy(*COLUMN, "row").agg(F.max(F.when(F.col("side") == 0, F.col("v"))).alias("cum_arr"), F.max(F.when(F.col("side") == 1, F.col("v"))).alias("cum_dep"), F.max("back").alias("suspect"), F.max("o").alias("o"))
    timed_stops = stage(_join(_join(stops.where("timed"), cum, [*COLUMN, "row"]), zones, [*TABLE, "seg", "row"]), "timed")

    served = (F.col("arr_kind") != "blank") | (F.col("dep_kind") != "blank")
    gaps = sequence.isolated_gaps(stops, COLUMN, ["row"], served)
    found.append(_finding(gaps, 1, 0, F.lit(5.0), F.col("station"), _cells((F.col("row"), F.col("a"))), 1, at(3, F.col("row"), F.lit(0)), F.lit("blank between two served stations — the train cannot skip a stop without a — (pass) mark")))

    dwells = timed_stops.where("cum_arr is not null and cum_dep is not null and not suspect").select(*COLUMN, "train", "station", "o", (F.col("cum_dep") - F.col("cum_arr")).alias("x"), _cells((F.col("row"), F.col("a")), (F.col("row"), F.col("b"))).alias("cells"))

    def leave(df):
        return df.withColumn("t0", F.coalesce("cum_dep", "cum_arr")).withColumn("t1", F.coalesce("cum_arr", "cum_dep")).withColumn("c0", F.when(F.col("cum_dep").isNotNull(), F.col("b")).otherwise(F.col("a"))).withColumn("c1", F.when(F.col("cum_arr").isNotNull(), F.col("a")).otherwise(F.col("b")))

    def steps(df):
        w = sequence.along(COLUMN, ["o"])
        nxt = F.lead(F.struct(F.col("station").alias("station"), "row", "t1", "c1", "suspect", "km", "zone")).over(w)
        out = leave(df).withColumn("n", nxt).where("n is not null and not suspect and not n.suspect")
        return out.withColumn("cells", _cells((F.col("row"), F.col("c0")), (F.col("n.row"), F.col("n.c1")))).withColumn("dt", F.col("n.t1") - F.col("t0"))

    legs = steps(timed_stops).where("dt >= 0 and station <> '' and n.station <> ''")
    legs = legs.select(*COLUMN, "train", F.col("station").alias("from_"), F.col("n.station").alias("to_"), "o", F.col("dt").alias("x"), "cells")
    speeds = steps(timed_stops.where("shape = 'distance' and km is not null")).where("zone = n.zone and km <> n.km")
    speeds = speeds.withColumn("dkm", F.abs(F.col("km") - F.col("n.km"))).withColumn("kmh", F.when(F.col("dt") > 0, F.col("dkm") / (F.col("dt") / 3600)))
    speeds = speeds.withColumn("station", _text(F.col("station"), " → ", F.col("n.station"))).withColumn("clock", _text("(", scalar.hhmm(F.col("t0")), " → ", scalar.hhmm(F.col("n.t1")), ")"))
    speeds = stage(speeds.select(*COLUMN, "train", "station", "o", "dt", "dkm", "kmh", "clock", "cells"), "speeds")
    far = _text(scalar.fixed_decimals(F.col("dkm"), 1), " km")
    found.append(_finding(speeds.where("dt <= 0"), 3, 0, F.lit(9.0), F.col("station"), F.col("cells"), 1, at(4, F.col("o"), F.lit(0)), _text(far, " covered in no time at all ", F.col("clock"))))
    fast = speeds.where(F.col("kmh") > config.max_kmh)
    found.append(_finding(fast, 3, 0, 7.0 + F.col("kmh") / config.max_kmh, F.col("station"), F.col("cells"), 1, at(4, F.col("o"), F.lit(0)), _text("implied ", scalar.fixed_decimals(F.col("kmh"), 0), f" km/h over {config.max_kmh:.0f} — ", far, " in ", scalar.mmss(F.col("dt")), " ", F.col("clock"))))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return {"findings": out, "legs": legs, "dwells": dwells, "speeds": speeds.where(F.col("kmh") <= config.max_kmh)}


def _back(run: DataFrame, at) -> DataFrame:
    """Steps back: inside a stop rule 2, between stops rule 1; two points more once midnight has passed."""
    base = run.where("back")
    late = (F.pmod("prev", F.lit(sequence.DAY)) >= EVENING) & (F.col("sec") <= MORNING) & (~F.col("at_stop") | (F.col("v") + sequence.DAY - F.col("prev") <= WRAP_DWELL))
    parts = []
    for stop, rule, what in ((True, 2, "departure before its arrival"), (False, 1, "time steps backwards along the run")):
        message = _text(what, ": ", scalar.hhmm(F.col("prev")), " then ", F.col("t"), F.when(late & F.col("after"), " — a second wrap in this column"))
        evidence = _evidence(("direction", F.when(F.col("way") == -1, "up the page").otherwise("down the page")))
        parts.append(_finding(base.where(F.col("at_stop") == stop), rule, 0, 6.0 + F.when(F.col("after"), 2.0).otherwise(0.0), F.col("station"), _cells((F.col("row"), F.col("c"))), 1, at(2, F.col("o"), F.col("side")), message, evidence))
    return parts[0].unionByName(parts[1])


def score_samples(s: dict[str, DataFrame], config: Config) -> DataFrame:
    """Legs against the same leg, dwells against the same station, speeds against the whole book."""
    order = [F.col(c) for c in ("scan", "half", "item", "seg", "pair", "o")]
    legs = stats.group_outliers(s["legs"], ["from_", "to_"], "x", config.min_samples, config.z, config.leg_ratio, config.leg_min_diff)
    dwells = stats.group_outliers(s["dwells"], ["station"], "x", config.min_samples, config.z, config.dwell_ratio, config.dwell_min_diff)
    speeds = stats.global_outliers(s["speeds"], "kmh", config.min_samples, config.z)
    dev = F.when(F.col("dev") == float("inf"), "inf").otherwise(scalar.fixed_decimals(F.when(F.col("dev") < float("inf"), F.col("dev")), 1))
    how = F.when(F.col("mad") != 0, "modified z").otherwise("ratio")

    def told(what):
        return _text(what, " ", scalar.mmss(F.col("x")), " against ", scalar.mmss(F.col("med")), " elsewhere (", how, " ", dev, ")"), _evidence(("n", F.col("n")), ("median", scalar.mmss(F.col("med"))), ("MAD", scalar.mmss(F.col("mad"))))

    out = _finding(legs, 4, 1, F.col("dev"), _text(F.col("from_"), " → ", F.col("to_")), F.col("cells"), 2, order, *told("running time"))
    out = out.unionByName(_finding(dwells, 2, 1, F.col("dev"), F.col("station"), F.col("cells"), 3, order, *told("dwell")))
    kmh = lambda c: _text(scalar.fixed_decimals(F.col(c), 0), " km/h")
    message = _text("implied ", kmh("kmh"), " against ", kmh("med"), " book-wide (", scalar.fixed_decimals(F.col("dkm"), 1), " km in ", scalar.mmss(F.col("dt")), ", modified z ", dev, ")")
    n = s["speeds"].where("kmh is not null").count()
    evidence = _evidence(("n", F.lit(n)), ("median", kmh("med")), ("MAD", scalar.fixed_decimals(F.col("mad"), 1)))
    return out.unionByName(_finding(speeds, 3, 1, F.col("dev"), F.col("station"), F.col("cells"), 4, order, message, evidence))


CLUSTER = ["scan", "folio", "shape", "train", "rules", "severity", "score", "station", "cells", "first", "message", "evidence", "texts"]


def collapse(found: DataFrame, config: Config) -> DataFrame:
    """One cell, one finding; a run of findings on one column, one finding."""
    numbered = found.withColumn("order", F.struct("phase", "seq"))
    w = Window.partitionBy("scan", "folio", "train").orderBy("order", "rule")
    numbered = numbered.withColumn("first", F.row_number().over(w).cast("bigint")).drop("order", "phase", "seq")

    rows = F.array_sort(F.collect_list(F.struct("first", "shape", "rule", "severity", "score", "station", "cells", "message", "evidence", "texts")))
    each = lambda field: F.transform("rows", lambda r: r[field])
    of = lambda x, *names: F.struct(*[x[n].alias(n) for n in names])

    def last_of(items: Column, names: tuple[str, ...], value: str) -> Column:
        """Of items with equal names the value of the last, where the first stood."""
        return F.transform(F.array_distinct(F.transform(items, lambda x: of(x, *names))), lambda k: F.struct(*[k[n].alias(n) for n in names], F.element_at(F.filter(items, lambda x: of(x, *names) == k), -1)[value].alias(value)))

    clusters = findings.collapse(numbered, ["scan", "folio", "train"], "first", "cells", rows=rows)
    clusters = clusters.withColumns({"evidence": F.flatten(each("evidence")), "texts": F.flatten(each("texts")), "top": F.get("rows", F.lit(0))})
    clusters = clusters.select(
        "scan", "folio", "top.shape", "train", F.array_sort(F.array_distinct(each("rule"))).cast("array<int>").alias("rules"), F.array_min(each("severity")).alias("severity"), F.array_max(each("score")).alias("score"), "top.station",
        F.array_distinct(F.flatten(each("cells"))).alias("cells"), "top.first", F.array_join(each("message"), "; ").alias("message"), last_of(F.col("evidence"), ("k",), "v").alias("evidence"), last_of(F.col("texts"), ("r", "c"), "t").alias("texts"),
    )
    clusters = stage(clusters, "clusters")
    some = clusters.where(F.size("cells") > 0).withColumn("cols", F.array_sort(F.array_distinct(F.transform("cells", lambda c: c["c"]))))
    some = some.withColumn("r0", F.array_min(F.transform("cells", lambda c: c["r"]))).withColumn("r1", F.array_max(F.transform("cells", lambda c: c["r"])))
    key = ["scan", "folio", "train", "cols"]
    w = Window.partitionBy(*key).orderBy("r0", "first")
    some = some.withColumn("g", F.sum(F.when(F.col("r0") <= F.lag("r1").over(w) + 1, 0).otherwise(1)).over(w)).withColumn("n", F.count("*").over(Window.partitionBy(*key, "g")))
    long = some.where(F.col("n") >= config.run).groupBy(*key, "g").agg(
        F.first("shape").alias("shape"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("rules")))).alias("rules"), F.lit(0).alias("severity"), (12.0 + F.count("*")).alias("score"),
        F.concat(F.lit("rows "), F.min("r0").cast("string"), F.lit("–"), F.max("r1").cast("string")).alias("station"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("cells", lambda c: c["r"]))))).alias("rows"), F.min("first").alias("first"),
        _text(F.count("*"), " findings on consecutive rows of one column — read as a column misaligned by a row, not as bad digits").alias("message"),
        F.array(F.struct(F.lit("first").alias("k"), F.min(F.struct("r0", "first", "message"))["message"].alias("v"))).alias("evidence"), F.array_distinct(F.flatten(F.collect_list("texts"))).alias("texts"),
    )
    long = long.withColumn("cells", F.flatten(F.transform("rows", lambda r: F.transform("cols", lambda c: F.struct(r.alias("r"), c.alias("c"))))))
    return clusters.where(F.size("cells") == 0).select(*CLUSTER).unionByName(some.where(F.col("n") < config.run).select(*CLUSTER)).unionByName(long.select(*CLUSTER))


def validate(spark: SparkSession, path: str, config: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """(train columns, findings with `weighted` score) of a folder of scan files."""
    f = read_columns(spark, path, config)
    zones, zone_findings, posts = _mileposts(spark, f, config)
    checked = check_columns(f["stops"], zones, config)
    found = _structure(spark, f, config).unionByName(zone_findings).unionByName(checked["findings"]).unionByName(score_samples(checked, config)).unionByName(_milepost_rule(posts, config))
    merged = collapse(stage(with_texts(found, f["stops"]), "findings"), config)
    columns = f["stops"].select(*COLUMN, "train").distinct()
    return columns, merged.withColumn("weighted", F.col("score") * (1 + 0.5 * (F.size("rules") - 1)))


def values(found: DataFrame) -> DataFrame:
    """found with `values`: the printed texts of its cells from top to bottom and left to right, ∅ for a blank; cells whose text is not known are left out."""
    own = F.filter(F.array_sort("texts"), lambda t: F.exists("cells", lambda c: (c["r"] == t["r"]) & (c["c"] == t["c"])))
    return found.withColumn("values", F.transform(own, lambda t: F.when(scalar.strip(t["t"]) == "", "∅").otherwise(scalar.strip(t["t"]))))


def apply_ignores(found: DataFrame, ignores: DataFrame, name: str = "ignore.txt") -> DataFrame:
    """found without what the ignore list excuses, and a finding for each entry that excuses nothing."""
    own = stage(values(found).withColumn("where", F.coalesce("station", F.lit(""))), "valued")
    left, stale = consistency.unmatched(own, ignores, ["scan", "folio", "train", "where"], "rules", "values")
    none = lambda t: F.array().cast(t)
    message = _text(name, " line ", F.col("line"), " matches no finding — its cells changed or the finding went; update the line or drop it")
    stale = stale.select(
        "scan", "folio", F.lit("ignore").alias("shape"), "train", F.array(F.lit(0)).alias("rules"), F.lit(0).alias("severity"), F.lit(100.0).alias("score"), F.col("where").alias("station"), none("array<struct<r:int,c:int>>").alias("cells"),
        (F.lit(1 << 40) + F.col("line")).cast("bigint").alias("first"), message.alias("message"), none(EVIDENCE).alias("evidence"), none(TEXTS).alias("texts"), F.lit(100.0).alias("weighted"),
    )
    return left.drop("where", "values").unionByName(stale)


def select_findings(found: DataFrame, rules: list[int] | None = None, impossible: bool = False) -> DataFrame:
    """Findings of any of these rules, and of those the impossible ones only; both are asked after collapsing."""
    if rules:
        found = found.where(F.arrays_overlap("rules", F.array(*map(F.lit, rules))))
    return found.where("severity = 0") if impossible else found


def _ranked(found: DataFrame) -> DataFrame:
    return consistency.number_rows(found, [F.col("severity"), F.col("weighted").desc(), F.col("scan"), F.col("folio"), F.col("train"), F.col("first")], "rank")


def findings_json(found: DataFrame) -> DataFrame:
    """(n, json): the findings in rank order, one JSON object each; an infinite score is the text Infinity, as JSON has no number for it."""
    score = F.when(F.col("score") == float("inf"), F.to_json(F.struct(F.lit("Infinity").alias("s")))).otherwise(F.to_json(F.struct(F.round("score", 3).alias("s"))))
    fields = F.struct(
        "severity", F.lit(0).alias("score"), F.array_sort("rules").alias("rules"), "message", F.map_from_entries("evidence").alias("evidence"), "scan", "folio", "shape", "train", "station",
        F.transform("cells", lambda c: F.array(c["r"], c["c"])).alias("cells"), "values",
    )
    text = F.to_json(fields, {"ignoreNullFields": "false"})
    # a score is a number or a text, which no column type is
    own = F.replace(text, F.lit('"score":0,'), F.concat(F.lit('"score":'), F.regexp_extract(score, r"\A\{\"s\":(.*)\}\z", 1), F.lit(",")))
    return values(_ranked(found)).select(F.col("rank").alias("n"), own.alias("json"))


HEAD = ["#", "level", "scan", "folio", "shape", "train", "where", "cells", "rules", "message", "evidence"]


def findings_lines(found: DataFrame, limit: int = 0) -> DataFrame:
    """(n, line): the findings in rank order as lines of an aligned table, the head at -1 and its rule at 0; no rows for no findings. limit shows the first so many."""
    ranked = _ranked(found)
    ranges = sinks.cell_ranges(ranked.select("rank", F.explode("cells").alias("x")).select("rank", "x.r", "x.c"), ["rank"], "r", "c")
    shown = ranked.join(ranges, "rank", "left")
    if limit:
        shown = shown.where(F.col("rank") <= limit)
    rules = F.array_join(F.transform(F.array_sort("rules"), lambda r: F.when(r == 0, "structure").otherwise(r.cast("string"))), ", ")
    cells = [
        F.col("rank"), F.when(F.col("severity") == 0, "IMPOSSIBLE").otherwise("deviation"), F.col("scan"), F.col("folio"), F.col("shape"), F.col("train"), F.col("station"), F.col("ranges"), rules, F.col("message"),
        F.array_join(F.transform("evidence", lambda e: F.concat(e["k"], F.lit("="), e["v"])), "  "),
    ]
    return numbered_lines(shown, "rank", HEAD, cells)


def summary(columns: DataFrame, found: DataFrame, limit: int = 0, ignored: int = 0, name: str = "ignore.txt") -> str:
    """The last lines of a report."""
    n = found.agg(F.count("*").alias("n"), F.count_if(F.col("severity") == 0).alias("hard")).first()
    shown = min(n.n, limit) if limit else n.n
    return (
        f"{columns.count()} train columns checked; {n.n} findings ({n.hard} impossible, {n.n - n.hard} deviations), {shown} shown" + (f", {ignored} ignored by {name}" if ignored else "") + ".\n"
        "Triage, not a verdict — check each against the scan. Nothing here has been repaired.\n"
    )
