"""Names as printed: odd letters, hyphen joins, notations and routes."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import scalar
from tidegauge.operators import fuzzy
from tidegauge.operators.scan import running_last, sequences
from tidegauge.sources.shared import stage

# Roman numbers in names, the word of a head of names, and what stands in a column of names without being one.
ROMAN = ["I", "II", "III", "IV", "V"]
NAME_HEAD = "пункт"
NO_NAME = r"(?U)\A[\d.,\s—\-]*\z|\A№|\AРазд|\AПрибытие\z|\A∅\z"


@F.pandas_udf(T.StringType())
def name_key(name: pd.Series) -> pd.Series:
    """Composed (NFC) and lower-cased; Spark has no function for the first."""
    return name.map(lambda n: None if n is None else unicodedata.normalize("NFC", n).lower())


def broken_hyphens(names: DataFrame, name: str) -> DataFrame:
    """Names with a hyphen that a space follows."""
    return names.where(F.col(name).rlike(r"\S- "))


def hyphen_lookups(names: DataFrame, name: str) -> DataFrame:
    """(name, printed, match): names with a hyphen inside a word whose parts join, give or take one edit, into a word of four letters or more in the names: the least such word. Of several hyphens the last that does."""
    words = names.select(F.explode(F.regexp_extract_all(F.col(name), F.lit("[А-яЁё]{4,}"), F.lit(0))).alias("word")).distinct()
    words = words.withColumn("key", name_key("word"))
    both = F.regexp_extract_all(F.col(name), F.lit("([А-яЁё]{2,})-([а-яё]{2,})"), F.lit(0))
    split = names.select(F.col(name).alias("name")).distinct().select("name", F.posexplode(both.alias("printed") if name == "name" else F.regexp_extract_all("name", F.lit("([А-яЁё]{2,})-([а-яё]{2,})"), F.lit(0))).alias("at", "printed"))
    split = split.withColumn("key", name_key(F.replace("printed", F.lit("-"), F.lit(""))))
    joined, plain = split.select("key").distinct(), words.select("key").distinct()
    near = fuzzy.within_distance(joined, plain, 1).select(F.col("x").alias("key"), F.col("y").alias("other"))
    near = near.unionByName(joined.join(plain, "key").select("key", F.col("key").alias("other")))
    least = near.join(words.withColumnRenamed("key", "other"), "other").groupBy("key").agg(F.min("word").alias("match"))
    return split.join(least, "key").groupBy("name").agg(F.max(F.struct("at", "printed", "match")).alias("m")).select("name", "m.printed", "m.match")


def checks(names: DataFrame, name: str) -> DataFrame:
    """(name, k, why): distinct names with a letter of another script, a hyphen that a space follows, or a hyphen that splits a known word."""
    own = names.select(F.col(name).alias("name")).distinct()
    odd = own.withColumn("odd", scalar.odd_letters(F.col("name"))).where(F.size("odd") > 0).select("name", F.lit(0).alias("k"), F.concat(F.lit("letter "), letter_names("odd")).alias("why"))
    broken = broken_hyphens(own, "name").select("name", F.lit(1).alias("k"), F.lit("«- » from a line break").alias("why"))
    joined = hyphen_lookups(own, "name").select("name", F.lit(2).alias("k"), F.concat(F.lit("«-» from a line break: "), F.col("printed"), F.lit(" joins into "), F.col("match")).alias("why"))
    return odd.unionByName(broken).unionByName(joined)


@F.pandas_udf(T.StringType())
def letter_names(letters: pd.Series) -> pd.Series:
    """Letters with their Unicode names, as a list in text; Spark has no function for them."""
    return letters.map(lambda own: ", ".join(f"{c} ({unicodedata.name(c, 'no name')})" for c in own))


def route_parts(text):
    """The names in a printed route, `A—B, C · D—E`, as an array: of 3 to 29 characters, without numbers, without a final full stop; capitals as a name."""
    bare = lambda c, marks: F.regexp_replace(scalar.strip(c), rf"\A[{marks}]+|[{marks}]+\z", "")
    parts = F.flatten(F.transform(F.split(text, "[·¦,]"), lambda p: F.split(bare(p, "⟨⟩#"), "—")))
    clean = F.transform(parts, lambda p: scalar.strip(bare(p, "⟨⟩#")))
    clean = F.transform(clean, lambda p: F.when(p.rlike(r"(?U)(\A|[\s-])[А-ЯЁ][^\s-]*\.\z"), F.regexp_replace(p, r"\.\z", "")).otherwise(p))
    kept = F.filter(clean, lambda p: F.length(p).between(3, 29) & ~p.rlike(r"(?U)[\d№]"))
    return F.transform(kept, lambda p: F.when((p == F.upper(p)) & (p != F.lower(p)), F.concat(F.substring(p, 1, 1), F.lower(F.substring(p, F.lit(2), F.length(p))))).otherwise(p))


def route_names(lines: DataFrame, text: str) -> DataFrame:
    """(name) of printed routes."""
    return lines.select(F.explode(route_parts(F.col(text))).alias("name"))


def spellings(cell):
    """The readings of a cell that are names, as an array: no numbers, train numbers, head words or blanks."""
    return F.filter(F.transform(scalar.readings(cell), scalar.strip), lambda n: (n != "") & ~n.rlike(NO_NAME))


def collect_names(lines: DataFrame) -> DataFrame:
    """(name, file, line) of every name printed in files given as (file, line, text), lines from 1.

    In tables the names stand in the column that the last head row calls so, the first one before any
    and after other text; notes and routes in other cells, and routes in text, count too.
    """
    piped = F.startswith("text", F.lit("|"))
    cells = F.transform(F.split(F.regexp_replace(scalar.strip(F.col("text")), r"\A\|+|\|+\z", ""), r"\|"), scalar.strip)
    rows = lines.withColumn("cells", F.when(piped & ~F.startswith("text", F.lit("|=")), cells))
    at = F.array_position(F.transform("cells", lambda c: F.contains(F.lower(c), F.lit(NAME_HEAD))), True)
    rows = rows.withColumn("head", F.when(at > 0, at - 1))
    other = ~piped & (scalar.strip(F.col("text")) != "")
    rows = sequences(rows, ["file"], ["line"]).add(_col=running_last(F.coalesce("head", F.when(other, 0)))).rows()
    rows = rows.withColumn("col", F.coalesce("_col", F.lit(0))).drop("_col")
    one = F.transform("cells", lambda c, i: F.when(i == F.col("col"), spellings(c)).when(c.rlike("\\AНа [А-ЯЁ]"), F.array(c)).when(F.contains(c, F.lit("—")) & c.rlike("[А-яЁё]"), route_parts(c)).otherwise(F.array().cast("array<string>")))
    found = rows.where("cells is not null and head is null").select("file", "line", F.explode(F.flatten(one)).alias("name"))
    routes = rows.where(~piped & F.contains("text", F.lit("—")) & ~F.col("text").rlike(r"\A(#|Не |Поезд)")).select("file", "line", F.explode(route_parts(F.col("text"))).alias("name"))
    return found.unionByName(routes).select("name", "file", "line")


def occurrences(names: DataFrame, name: str, place: str) -> DataFrame:
    """(name, n, places): how often and where a name is printed."""
    return names.groupBy(name).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(place)).alias("places"))


def _worded(df: DataFrame, name: str) -> DataFrame:
    """df with words, seps (printed before each) and short (whether a word is an abbreviation: it ends in a full stop, or is one letter before a /)."""
    df = df.withColumn("_t", scalar.tokens(F.col(name)))
    df = df.withColumn("words", F.transform("_t", lambda t: t["word"])).withColumn("seps", F.transform("_t", lambda t: t["before"])).drop("_t")
    short = F.transform("words", lambda w, i: F.endswith(w, F.lit(".")) | (w.rlike(r"\A\p{L}\z") & (F.coalesce(F.get("seps", i + 1), F.lit("")) == "/")))
    return df.withColumn("short", short)


def _bare(word):
    return F.lower(F.regexp_replace(word, r"(?U)[^\w]", ""))


def notation_parts(names: DataFrame, name: str) -> DataFrame:
    """(name, place, key, printed): the abbreviations in front of a name, and an abbreviation or Roman number at its end; the key ignores case and signs."""
    df = _worded(names.select(F.col(name).alias("name")).where("name is not null").distinct(), "name")
    n = F.size("words")
    run = F.when(F.array_contains("short", False), F.array_position("short", False) - 1).otherwise(n)
    df = df.withColumn("i", F.least(run, F.greatest(n - 1, F.lit(0))).cast("int"))
    lead = F.slice(F.zip_with("seps", "words", lambda s, w: F.concat(s, w)), F.lit(1), F.col("i"))
    front = F.struct(F.lit("front").alias("place"), F.array_join(F.transform(F.slice("words", F.lit(1), F.col("i")), _bare), "").alias("key"), F.concat(F.array_join(lead, ""), F.get("seps", F.col("i")), F.lit("…")).alias("printed"))
    last, sep = F.get("words", n - 1), F.get("seps", n - 1)
    tail = (n > 1) & (F.col("i") < n - 1)
    roman = F.struct(F.lit("end").alias("place"), F.lit("Roman number").alias("key"), F.concat(F.lit("…"), sep, F.lit("I…")).alias("printed"))
    short = F.struct(F.lit("end").alias("place"), _bare(last).alias("key"), F.concat(F.lit("…"), sep, last).alias("printed"))
    ends = F.when(tail & last.isin(ROMAN), roman).when(tail & F.endswith(last, F.lit(".")) & last.rlike(r"\A\p{Ll}") & (F.length(last) > 2), short)
    parts = F.filter(F.array(F.when(F.col("i") > 0, front), ends), lambda p: p.isNotNull())
    return df.select("name", F.explode(parts).alias("p")).select("name", "p.place", "p.key", "p.printed")


def _abbreviated(shapes: DataFrame) -> DataFrame:
    """(x, y) of shapes as many words long, each word of which is the other's or abbreviates it, one at least, while the first or the last word agrees.

    A pair has an abbreviation at some place and agrees at one end. Short words give (length, end, word there, place, abbreviation), whole words the same
    with each of their beginnings, so all that meets shares an agreeing end and one abbreviation; the other words are compared then.
    """
    own = _worded(shapes, "shape").where(F.size("words") > 1).withColumn("n", F.size("words"))
    ends = own.select("*", F.explode(F.array(F.lit(0), F.col("n") - 1)).alias("end")).withColumn("agreed", F.get("words", F.col("end")))
    placed = ends.select("shape", "n", "end", "agreed", "short", F.posexplode("words").alias("i", "w")).where("i <> end")
    key = ["n", "end", "agreed", "i", "part"]
    cut = placed.where(F.get("short", F.col("i"))).select(F.col("shape").alias("x"), "n", "end", "agreed", "i", _bare(F.col("w")).alias("part")).where("part <> ''")
    whole = placed.where(F.col("w").rlike(r"\A\p{L}{2,}\z"))
    begins = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda k: F.substring(F.lower("w"), F.lit(1), k))
    whole = whole.select(F.col("shape").alias("y"), "n", "end", "agreed", "i", F.explode(F.array_distinct(begins)).alias("part"))
    met = cut.join(whole, key).where("x <> y").select("x", "y").distinct()
    of = lambda c, words, short: own.select(F.col("shape").alias(c), F.col("words").alias(words), F.col("short").alias(short))
    pairs = met.join(of("x", "words", "short"), "x").join(of("y", "v", "full_short"), "y")
    abbreviates = lambda x, y: ~F.endswith(y, F.lit(".")) & y.rlike(r"\A\p{L}+\z") & (F.length(_bare(x)) < F.length(y)) & (_bare(x) != "") & F.startswith(F.lower(y), _bare(x))
    both = F.transform("words", lambda w, i: F.when(w == F.get("v", i), 0).when(F.get("short", i) & abbreviates(w, F.get("v", i)), 1).when(F.get("full_short", i) & abbreviates(F.get("v", i), w), 1).otherwise(2))
    pairs = pairs.withColumn("d", both)
    return pairs.where(F.exists("d", lambda d: d == 1) & ~F.exists("d", lambda d: d == 2) & ((F.element_at("d", 1) == 0) | (F.element_at("d", -1) == 0))).select("x", "y")


def notation_links(names: DataFrame, name: str) -> DataFrame:
    """(why, x, y), x < y: shapes of names (numbers as #) that differ in notation alone.

    * number: one word is a number in one and the same Roman number in the other;
    * abbreviation: words stand against their abbreviations, in either direction, and the first
      or the last word agrees; numbers agree whatever they are;
    * word before a milepost: `78 км` and `Пост 78 км`.

    Each kind meets on a key of its own (the words with the number taken out and its value; an abbreviation, its place and the
    word that agrees, over distinct shapes; the milepost), so shapes that merely share their initials form no pair.
    """
    own = names.select(F.col(name).alias("name")).where("name is not null").distinct().withColumn("shape", scalar.number_shape(F.col("name")))
    worded = _worded(own, "name")
    number = lambda w: w.rlike(r"(?U)\A[\d,]+\z")
    plain = F.transform("words", lambda w: F.when(number(w), "#").otherwise(w))
    at = worded.where(F.size("words") > 1).select("shape", plain.alias("words"), F.posexplode("words").alias("i", "w"))
    key = F.array_join(F.transform("words", lambda w, j: F.when(j == F.col("i"), "#").otherwise(w)), "\x00")
    value = F.when(F.col("w").isin(ROMAN), F.array_position(F.array(*map(F.lit, ROMAN)), F.col("w")).cast("string")).when(F.col("w").rlike(r"\A\d+\z"), F.regexp_replace("w", r"\A0+(?=\d)", ""))
    at = at.select("shape", "i", key.alias("key"), value.alias("value"), F.col("w").isin(ROMAN).alias("roman")).where("value is not null").distinct()
    r, a = at.where("roman").drop("roman"), at.where("not roman").drop("roman")
    numbers = r.withColumnRenamed("shape", "x").join(a.withColumnRenamed("shape", "y"), ["i", "key", "value"]).select(F.lit("number").alias("why"), "x", "y")

    pairs = _abbreviated(own.select("shape").distinct())
    short = pairs.select(F.lit("abbreviation").alias("why"), "x", "y")

    post = own.where(F.col("name").rlike(r"(?U)\A[\d,]+ км\z")).select(F.col("name").alias("post"), F.col("shape").alias("x"))
    word = own.where(F.col("name").rlike(r"(?U)\A[А-ЯЁ][а-яё]{2,} [\d,]+ км\z")).select(F.regexp_replace("name", r"\A[^ ]+ ", "").alias("post"), F.col("shape").alias("y"))
    posts = post.join(word, "post").select(F.lit("word before a milepost").alias("why"), "x", "y")
    out = numbers.unionByName(short).unionByName(posts).where("x <> y")
    return out.select("why", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def notations(names: DataFrame, name: str) -> DataFrame:
    """(why, group, printed, name): every name of each part that is printed in more than one way, and of each group of shapes linked by one kind of difference."""
    parts = notation_parts(names, name)
    ways = parts.groupBy("place", "key").agg(F.countDistinct("printed").alias("n")).where("n > 1")
    found = parts.join(ways, ["place", "key"]).select(F.concat("place", F.lit(" part printed "), F.col("n").cast("string"), F.lit(" ways")).alias("why"), F.concat_ws("\x00", F.lit("part"), "place", "key").alias("group"), "printed", "name")
    links = notation_links(names, name)
    node = lambda c: F.concat_ws("\x00", "why", c)
    groups = fuzzy.components(links.select(node("x").alias("u"), node("y").alias("v")))
    groups = groups.select(F.split("node", "\x00")[0].alias("why"), F.split("node", "\x00")[1].alias("printed"), F.concat_ws("\x00", F.lit("shape"), "component").alias("group"))
    shaped = names.select(F.col(name).alias("name")).where("name is not null").distinct().withColumn("printed", scalar.number_shape(F.col("name")))
    return found.unionByName(groups.join(shaped, "printed").select("why", "group", "printed", "name"))


def set_against(found: DataFrame) -> DataFrame:
    """(group, printed, name, n_against): the names of each notation finding, and how many names of the group are printed in another way than theirs.

    Two names are set against each other exactly where they share a group and differ in `printed`, so these rows tell all pairs, and none is spelt out.
    """
    own = stage(found.select("group", "printed", "name").distinct(), "noted")
    ways = stage(own.groupBy("group", "printed").agg(F.count("*").alias("m")), "ways")
    every = ways.groupBy("group").agg(F.sum("m").alias("n"))
    return own.join(ways.join(every, "group"), ["group", "printed"]).select("group", "printed", "name", (F.col("n") - F.col("m")).alias("n_against"))


def pair_levels(names: DataFrame, name: str, max_dist: int, ratio: float) -> DataFrame:
    """(d, x, y), x < y: names whose keys are within max_dist edits and `ratio` of the shorter key, each pair at its distance."""
    own = names.select(F.col(name).alias("name")).distinct().withColumn("key", name_key("name"))
    keys = fuzzy.fuzzy_pairs(own, max_dist, ratio)
    a, b = own.select(F.col("key").alias("x"), F.col("name").alias("nx")), own.select(F.col("key").alias("y"), F.col("name").alias("ny"))
    return keys.join(a, "x").join(b, "y").select("d", F.least("nx", "ny").alias("x"), F.greatest("nx", "ny").alias("y"))


def pattern(p: str) -> str:
    """A golden notation as a regular expression: … is any text, # a number."""
    import re

    return "(?U)\\A" + "".join({"…": ".*", "#": r"[\d,]+"}.get(c, re.escape(c)) for c in p) + "\\z"


def _literals(p: str) -> list[str]:
    """Stretches of a golden notation's text, any of which a name must hold to match: of three letters, or as long as its longest text; an empty one where it has none."""
    import re

    pieces = [x for x in re.split("[…#]", p) if x]
    size = min(3, max(map(len, pieces), default=0))
    return sorted({x[i : i + size] for x in pieces for i in range(len(x) - size + 1)}) if size else [""]


def match_patterns(names: DataFrame, patterns: list[tuple[int, str]]) -> DataFrame:
    """(id, name) of names (distinct) and the patterns (id, golden notation) that they match.

    Each pattern is looked up by one stretch of its own text, the one that the fewest names hold: names give all their stretches of the lengths asked for,
    and only names that hold the stretch are matched with the regular expression. A pattern without text meets all names.
    """
    spark = names.sparkSession
    asked = [(i, pattern(p), g) for i, p in patterns for g in _literals(p)]
    if not asked:
        return names.select(F.lit(0).alias("id"), "name").where("false")
    asked_ = spark.createDataFrame(asked, "id int, regex string, gram string")
    cut = lambda k: F.transform(F.sequence(F.lit(1), F.length("name") - k + 1), lambda i: F.substring("name", i, F.lit(k))) if k else F.array(F.lit(""))
    lists = [F.when(F.length("name") >= k, cut(k)).otherwise(F.array().cast("array<string>")) for k in sorted({len(g) for *_, g in asked})]
    grams = stage(names.select("name", F.explode(F.array_distinct(F.concat(*lists))).alias("gram")).join(asked_.select("gram").distinct(), "gram"), "grams")
    held = asked_.join(grams.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left")
    best = held.groupBy("id", "regex").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return grams.join(best, "gram").where(F.regexp_like("name", F.col("regex"))).select("id", "name")


def golden_score(names: DataFrame, golden: list[tuple[str, str, str, str]], max_dist: int, ratio: float) -> DataFrame:
    """(line, tag, form, target, count, got, result) of golden lines (tag, form, target, count) against printed names (one row an occurrence).

    A line with … or # is found if every name printed as the form is set against one printed as the target; another
    if the two are paired, flagged by a check or set against each other. Otherwise the result says what is missing.
    """
    spark = names.sparkSession
    counts = stage(names.groupBy("name").agg(F.count("*").alias("n")), "counts")
    noted = stage(notations(counts, "name").select("group", "printed", "name").distinct(), "noted")
    is_wild = [any(c in g[1] for c in "…#") for g in golden]
    lines = spark.createDataFrame([(i, *g, w) for i, (g, w) in enumerate(zip(golden, is_wild))], "line int, tag string, form string, target string, count string, wild boolean")
    # patterns: a line's form is 2 i, its target 2 i + 1
    wild = lines.where("wild")
    known = counts.where("name is not null")
    matched = stage(match_patterns(known.select("name"), [(2 * i + j, g[1 + j]) for i, (g, w) in enumerate(zip(golden, is_wild)) if w for j in (0, 1)]), "matched")
    line = F.floor(F.col("id") / 2).cast("int").alias("line")
    fs = stage(matched.where("id % 2 = 0").select(line, "name").join(known, "name"), "forms")
    ts = matched.where("id % 2 = 1").select(line, "name")
    # a form is met where its group prints a target in another way, which the least and the greatest way tell
    ways = ts.join(noted, "name").groupBy("line", "group").agg(F.min("printed").alias("low"), F.max("printed").alias("high"))
    met = fs.join(noted, "name").join(ways, ["line", "group"]).where("printed <> low or printed <> high").select("line", "name").distinct()
    forms = fs.join(met.withColumn("met", F.lit(True)), ["line", "name"], "left").groupBy("line").agg(
        F.sum("n").alias("got"), F.count("*").alias("nf"), F.array_sort(F.collect_list(F.when(F.col("met").isNull(), F.col("name")))).alias("left")
    )
    wide = wild.join(forms, "line", "left").join(ts.groupBy("line").agg(F.count("*").alias("nt")), "line", "left")
    text = lambda *c: F.concat(*[F.col(x).cast("string") if isinstance(x, str) and x in ("nf", "nt", "miss", "d") else F.lit(x) for x in c])
    wide = wide.withColumn("miss", F.size(F.coalesce("left", F.array().cast("array<string>"))))
    wide = wide.withColumn("result", F.when(F.col("nf").isNull(), "MISS form not in dir").when(F.col("nt").isNull(), "MISS target not printed")
        .when(F.col("miss") > 0, F.concat(text("MISS notation, ", "miss", " of ", "nf", " names not set against the target: "), F.array_join("left", ", ")))
        .otherwise(text("found by notations (", "nf", " names ~ ", "nt", " names)")))
    # names
    plain = lines.where("not wild").withColumn("kf", name_key("form")).withColumn("kt", name_key("target")).withColumn("d", F.levenshtein("kf", "kt"))
    shorter = F.least(F.length("form"), F.length("target"))
    plain = plain.withColumn("ratio", F.col("d") / shorter)
    have = counts.select(F.col("name").alias("form"), F.col("n").alias("got"))
    plain = plain.join(have, "form", "left").join(counts.select(F.col("name").alias("target"), F.lit(True).alias("printed_target")), "target", "left")
    flagged = checks(counts, "name").select(F.col("name").alias("form")).distinct().withColumn("flagged", F.lit(True))
    plain = plain.join(flagged, "form", "left")
    x, y = noted.select("group", F.col("printed").alias("p"), F.col("name").alias("form")), noted.select("group", F.col("printed").alias("q"), F.col("name").alias("target"))
    against = plain.select("line", "form", "target").join(x, "form").join(y, ["group", "target"]).where("p <> q and form <> target").select("line").distinct().withColumn("noted", F.lit(True))
    plain = plain.join(against, "line", "left")
    paired = F.col("printed_target") & F.col("d").between(1, max_dist) & (F.col("d") / F.least(F.length("kf"), F.length("kt")) <= ratio)
    plain = plain.withColumn("result", F.when(F.col("got").isNull(), "MISS form not in dir").when(paired, F.concat(F.lit("found at d"), F.col("d").cast("string"), F.when(F.col("flagged"), "; flagged by checks").otherwise("")))
        .when(F.col("flagged"), "found by checks").when(F.col("noted"), "found by notations").when(F.col("printed_target").isNull(), "MISS target not printed")
        .otherwise(F.concat(F.lit("MISS d"), F.col("d").cast("string"), F.lit(", ratio "), scalar.fixed_decimals(F.col("ratio"), 2))))
    keep = ["line", "tag", "form", "target", "count", F.coalesce("got", F.lit(0)).cast("bigint").alias("got"), "result"]
    return wide.select(*keep).unionByName(plain.select(*keep))


def golden_tally(scored: DataFrame) -> DataFrame:
    """(outcome, n): how many golden lines are found and how many MISS."""
    return scored.groupBy(F.substring_index("result", " ", 1).alias("outcome")).agg(F.count("*").alias("n"))


def unexplained(pairs: DataFrame, golden: list[tuple[str, str, str, str]]) -> DataFrame:
    """Pairs neither name of which a golden line has."""
    told = pairs.sparkSession.createDataFrame([(g[i],) for g in golden for i in (1, 2)], "told string").distinct()
    return pairs.join(told, F.col("x") == F.col("told"), "left_anti").join(told, F.col("y") == F.col("told"), "left_anti")


def report(names: DataFrame, title: str, max_dist: int = 2, ratio: float = 0.5) -> DataFrame:
    """(o, line): the lines of a report on (name, file) occurrences, in the order of the array o: checks, notations, and pairs by distance."""
    seen = stage(occurrences(names.withColumn("place", F.regexp_replace("file", r"\Ascan-|\.md\z", "")), "name", "place"), "seen")
    shown = F.concat(F.col("name"), F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    placed = F.concat(F.lit("["), F.array_join("places", " "), F.lit("]"))
    line = lambda df, o, text: df.select(F.array(*[x.cast("string") for x in o]).alias("o"), text.alias("line"))
    z, pad = F.lit(""), lambda c: F.lpad(c.cast("string"), 6, "0")
    head = seen.agg(F.concat(F.lit(f"# {title}: "), F.count("*").cast("string"), F.lit(f" names, max distance {max_dist}, ratio {ratio}")).alias("t"))
    out = line(head, [F.lit("0"), z, z, z], F.col("t"))
    one = names.sparkSession.range(1)
    for o, t in (("1", ""), ("2", "## checks"), ("4", "")):
        out = out.unionByName(line(one, [F.lit(o), z, z, z], F.lit(t)))
    found = checks(seen, "name").join(seen, "name")
    out = out.unionByName(line(found, [F.lit("3"), F.col("name"), F.col("k"), z], F.concat(F.lit("  "), shown, F.lit("  "), F.col("why"), F.lit("  "), placed)))
    noted = stage(notations(seen, "name").join(seen, "name"), "noted")
    kinds = noted.groupBy("why", "group").agg(F.array_join(F.array_sort(F.collect_set("printed")), "\x00").alias("g"))
    part = F.when(F.startswith("group", F.lit("part")), F.concat(F.lit("0"), F.col("group"))).otherwise(F.concat(F.lit("1"), F.col("why")))
    key = [F.lit("6"), part, F.col("g")]
    out = out.unionByName(line(kinds.agg(F.concat(F.lit("## notations: "), F.count("*").cast("string")).alias("t")), [F.lit("5"), z, z, z], F.col("t")))
    out = out.unionByName(line(kinds, [*key, z], F.concat(F.lit("  "), F.col("why"))))
    forms = noted.groupBy("why", "group", "printed").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", F.concat(shown, F.lit(" "), placed).alias("t")))), lambda x: x["t"]), ", ").alias("t"), F.min("name").alias("first"))
    # parts come in the order of their first names, shapes in their own
    place = F.when(F.startswith("group", F.lit("part")), F.col("first")).otherwise(F.col("printed"))
    out = out.unionByName(line(forms.join(kinds, ["why", "group"]), [*key, F.concat(F.lit("1"), place)], F.concat(F.lit("    "), F.col("printed"), F.lit(": "), F.col("t"))))
    pairs = stage(pair_levels(seen, "name", max_dist, ratio), "pairs")
    counted = names.sparkSession.range(1, max_dist + 1).select(F.col("id").cast("int").alias("d")).join(pairs.groupBy("d").agg(F.count("*").alias("m")), "d", "left").fillna(0)
    out = out.unionByName(line(counted, [F.lit("7"), pad(F.col("d")), z, z], F.lit("")))
    out = out.unionByName(line(counted, [F.lit("7"), pad(F.col("d")), F.lit("!"), z], F.concat(F.lit("## distance "), F.col("d").cast("string"), F.lit(": "), F.col("m").cast("string"), F.lit(" new pairs"))))
    side = lambda c: seen.select(F.col("name").alias(c), F.col("n").alias(f"n{c}"), F.concat(shown, F.lit(" "), placed).alias(f"t{c}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    swap = F.col("nx") < F.col("ny")
    text = F.concat(F.lit("  "), F.when(swap, F.col("ty")).otherwise(F.col("tx")), F.lit("  ~  "), F.when(swap, F.col("tx")).otherwise(F.col("ty")))
    return out.unionByName(line(both, [F.lit("7"), pad(F.col("d")), F.concat(F.lit("~"), F.col("x")), F.col("y")], text))


def dump(names: DataFrame) -> DataFrame:
    """(name, line): every name with its count."""
    return names.groupBy("name").agg(F.count("*").alias("n")).select("name", F.concat(F.col("n").cast("string"), F.lit("\t"), F.col("name")).alias("line"))
