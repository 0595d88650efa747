"""Cell functions as Column expressions: cleaning, clock times, kilometres, readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The clock (to 24.00) and kilometre formats, a lone hour, emphasis round a cell, a footnote mark after a train number, and the marks of readings.
TIME = r"\A(?:(?:[01]?\d|2[0-3])\.[0-5]\d|24\.00)(?:,5)?\z"
EMPHASIS = r"(?s)\A(\*\*|__|\*|_)(\S(?:.*\S)?)\1\z"
LONE_HOUR = r"(?U)\b(\d)\.(\d{2})\b"
FOOTNOTE = r"(?<=\d)\*{1,2}|(?<=\d Д)\*{1,2}|(?<=\d ДР)\*{1,2}"
KM = r"\A\d{1,4}[.,]\d\z"
OPEN, BAR, CLOSE, EMPTY = "⟨", "¦", "⟩", "∅"
DAY = 86400


#: Characters of Unicode's White_Space property.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without Unicode white space at the ends (trim() takes spaces only, and a pattern looks at every stretch of them inside)."""
    return F.trim(c, F.lit(WHITE))


def clean_cell(c: Column, pad_time: bool | Column = True) -> Column:
    """Strip; drop emphasis round the whole cell; unescape; pad lone hours anywhere in it (columns of names and distances: pad_time false); strip."""
    c = F.regexp_replace(strip(c), EMPHASIS, "$2")
    c = F.regexp_replace(c, r"\\([*_])", "$1")
    padded = F.regexp_replace(c, LONE_HOUR, "0$1.$2")
    return strip(F.when(pad_time, padded).otherwise(c) if isinstance(pad_time, Column) else padded if pad_time else c)


def time_seconds(c: Column) -> Column:
    """Seconds of `HH.MM` or `HH.MM,5` (half a minute); null for anything else, minutes over 59 or hours over 24. One match decides, places do the rest."""
    hour, rest = F.substring_index(c, ".", 1).try_cast("int"), F.substring_index(c, ".", -1)
    return F.when(c.rlike(TIME), hour * 3600 + F.substring(rest, 1, 2).try_cast("int") * 60 + F.when(F.length(rest) > 2, 30).otherwise(0))


def cell_kind(c: Column) -> Column:
    """blank, pass (a dash), time, bad (other text with a digit) or note."""
    return F.when(c == "", "blank").when(c.isin("—", "-", "–"), "pass").when(c.rlike(TIME), "time").when(c.rlike(r"\d"), "bad").otherwise("note")


def km_tenths(c: Column) -> Column:
    """Kilometres with one decimal, in tenths; null for anything else."""
    return F.when(c.rlike(KM), F.regexp_replace(c, "[.,]", "").try_cast("int"))


def hhmm(seconds: Column) -> Column:
    """Seconds modulo a day as HH.MM, with ,5 where they are not whole minutes."""
    s = F.pmod(seconds.cast("bigint"), F.lit(DAY))
    text = F.concat(F.lpad(F.floor(s / 3600).cast("string"), 2, "0"), F.lit("."), F.lpad(F.floor(F.pmod(s, F.lit(3600)) / 60).cast("string"), 2, "0"))
    return F.concat(text, F.when(F.pmod(s, F.lit(60)) != 0, ",5").otherwise(""))


def mmss(seconds: Column) -> Column:
    """Signed M:SS; halves of a second go to the even one."""
    s = F.bround(F.abs(seconds.cast("double")), 0).cast("bigint")
    return F.concat(F.when(seconds < 0, "-").otherwise(""), F.floor(s / 60).cast("string"), F.lit(":"), F.lpad(F.pmod(s, F.lit(60)).cast("string"), 2, "0"))


def cite(c: Column) -> Column:
    return F.concat(F.lit(OPEN), c, F.lit(CLOSE))


def variants(values: Column) -> Column:
    """⟨a ¦ b⟩ from an array of strings; an empty one is ∅."""
    return cite(F.array_join(F.transform(values, lambda v: F.when(v == "", EMPTY).otherwise(v)), f" {BAR} "))


def readings(c: Column) -> Column:
    """The values of ⟨a ¦ b⟩, or the cell itself as the only one."""
    inner = F.regexp_extract(c, f"(?s)\\A{OPEN}(.*){CLOSE}\\z", 1)
    parts = F.transform(F.split(inner, BAR), lambda p: F.when(strip(p) == EMPTY, "").otherwise(strip(p)))
    return F.when(c.rlike(f"(?s)\\A{OPEN}.*{CLOSE}\\z"), parts).otherwise(F.array(c))


def number_shape(c: Column) -> Column:
    """Numbers replaced by #."""
    return F.regexp_replace(c, r"\d+(,\d+)?", "#")


def odd_letters(c: Column) -> Column:
    """Letters outside Cyrillic, Roman numerals aside."""
    return F.regexp_extract_all(F.regexp_replace(c, r"(?<![A-Za-z])[IVX]+(?![A-Za-z])", ""), F.lit(r"[\p{L}&&[^А-яёЁ]]"), F.lit(0))


def tokens(c: Column) -> Column:
    """Words between white space, / and -, each with the separator printed before it."""
    return F.transform(
        F.regexp_extract_all(c, F.lit(r"(?U)[\s/-]*[^\s/-]+"), F.lit(0)),
        lambda t: F.struct(F.regexp_extract(t, r"(?U)\A[\s/-]*", 0).alias("before"), F.regexp_extract(t, r"(?U)[^\s/-]+\z", 0).alias("word")),
    )


def stray_markup(c: Column) -> Column:
    """Whether a * or _ is left that is no footnote mark."""
    return F.regexp_replace(c, FOOTNOTE, "").rlike(r"[*_]")


def one_cell(text: Column, at: Column, width: Column) -> Column:
    """A row of `width` blanks with `text` in place `at`."""
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.when(i == at, text).otherwise(""))


def fixed_decimals(x: Column, places: int) -> Column:
    """A number with so many decimals, halves to even, without grouping commas."""
    return F.replace(F.format_number(x.cast("double"), places), F.lit(","), F.lit(""))


def is_noise(c: Column) -> Column:
    """Blank lines, page numbers and sheet marks."""
    return c.rlike(r"\A\s*\z") | c.rlike(r"\A\d{1,3}\z") | c.rlike(r"\A\d+\s*(—\s*\d+|\\?\*)\z")


def escape_html(c: Column) -> Column:
    """HTML-escaped, quotes too; without the stray mark ^{}[], `\\*` and `\\_` unescaped, line ends as <br>."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"), ("^{}[]", "")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.replace(F.regexp_replace(c, r"\\([*_])", "$1"), F.lit("\n"), F.lit("<br>"))
