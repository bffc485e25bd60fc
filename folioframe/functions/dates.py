"""Dates in texts as Column expressions. A text is cut into numbers and words with what stands between them; three neighbours that
read as year, month and day in some order are a date. The first one of a text counts; if its day is impossible there is none.
Years of two digits turn at a pivot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A date that means none was found, the months, and the words that join the ends of a range.
NO_DATE = "2222-02-02"
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
JOINING = ("to", "thru", "through")
#: Numeric dates as they stand, for use behind a label.
ANY = r"\b\d{4}[-/]\d{1,2}[-/]\d{1,2}\b|\b\d{1,2}[-/.]\d{1,2}[-/.](?:\d{4}|\d{2})\b"

_TOKEN = r"[0-9]+|\p{L}+"
#: Spellings of a date as patterns on whole tokens. A month is its name or the first three letters of it or more.
_MONTH = "(?i:" + "|".join(m[:3] + "".join(f"(?:{c}" for c in m[3:]) + ")?" * len(m[3:]) for m in MONTHS) + ")"
_BREAK = r"\n\r\x{85}\x{2028}\x{2029}"
_NO_DASH = rf"(?=[0-9A-Za-z])(?<![-/])(?<![-/][{_BREAK}])(?<![-/]\r\n)"


def full_year(y: Column, pivot: int = 50) -> Column:
    return F.when(y >= 100, y).when(y < pivot, y + 2000).otherwise(y + 1900)


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once: a name for it, because expressions in lambdas and branches are computed where they stand."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _date(y, m, d) -> Column:
    """Null where there is no such day."""
    return F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), m.cast("string"), F.lit("-"), d.cast("string")).try_cast("date")


def _spelt(short_year: bool = False) -> str:
    """Year first, month/day/year, Month D Y or D Month Y. short_year: years behind a month's name may have two digits."""
    year = r"(?:[0-9]{4}|[0-9]{2})" if short_year else "[0-9]{4}"
    loose = lambda marks: rf"(?:{marks}\s+[{_BREAK}]?|[-/.])"
    forms = [
        r"(?<![0-9])[0-9]{4}(?:-[0-9]{1,2}-|/[0-9]{1,2}/)[0-9]{1,2}",
        r"(?<![0-9])[0-9]{1,2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.| / [0-9]{1,2} / )(?:[0-9]{4}|[0-9]{2})",
        rf"(?<!\p{{L}}){_MONTH}{loose('[.]?')}[0-9]{{1,2}}{loose(',?')}{year}",
        rf"(?<![0-9])[0-9]{{1,2}}{loose('')}{_MONTH}{loose('[.]?,?')}{year}",
    ]
    return f"(?:{'|'.join(forms)})(?![0-9])"


def _plain(x: Column) -> Column:
    """A text without the ends of ordinal numbers."""
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"(?i)(?<=[0-9])(?:st|nd|rd|th)\b", "")


def _read(spelt: Column, pivot: int) -> Column:
    """The date that a match of _spelt() means; null where its day is impossible, and for no match."""

    def parts(t):
        a, b, c = (F.get(t, F.lit(i)) for i in range(3))
        number = lambda v: v.try_cast("int")
        month = lambda w: (F.instr(F.lit(" ".join(m[:3] for m in MONTHS)), F.lower(F.substring(w, 1, 3))) + 3) / 4
        triple = lambda y, m, d: F.struct(number(y).alias("y"), m.cast("int").alias("m"), number(d).alias("d"))
        found = F.when(a.rlike("^[0-9]{4}"), triple(a, number(b), c)).when(~a.rlike("^[0-9]"), triple(c, month(a), b))
        return found.when(~b.rlike("^[0-9]"), triple(c, month(b), a)).otherwise(triple(c, number(a), b))

    tokens = F.when(spelt != "", F.regexp_extract_all(spelt, F.lit(_TOKEN), F.lit(0)))
    return _let(tokens, lambda t: _let(parts(t), lambda p: _date(full_year(p["y"], pivot), p["m"], p["d"])))


def parse_any(x: Column, pivot: int = 50, short_year: bool = False) -> Column:
    """The first date of a text: year first, month/day/year, Month D, Y or D Month Y. One pattern finds it, so a text is read once."""
    return _let(F.regexp_extract(_plain(x), _NO_DASH + _spelt(short_year), 0), lambda found: _read(found, pivot))


def canonical(x: Column) -> Column:
    """ISO where the value is a date (with or without a time of day, in eight digits, or with a month's name), else the value in lower case."""
    packed = F.regexp_replace(F.trim(x), r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    value = F.regexp_replace(packed, r"(?i)[T\s]+[0-9]{1,2}:[0-9]{2}.*$", "")
    return F.coalesce(parse_any(value, short_year=True).cast("string"), F.lower(F.trim(x)))


def find(x: Column) -> Column:
    """All numeric dates of a text, as they stand."""
    return F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(ANY), F.lit(0))


def range_end(x: Column, pivot: int = 50) -> Column:
    """Of two dates with a dash or a joining word between them: the second, where it is later than the first."""
    ends = rf"{_NO_DASH}({_spelt()})(?: *[-–] *| *(?i:{'|'.join(JOINING)})(?!\p{{L}}) *)({_spelt()})"

    def later(pair):
        both = F.struct(*(_read(F.regexp_extract(pair, f"^{ends}", i), pivot).alias(k) for i, k in ((1, "a"), (2, "b"))))
        return _let(both, lambda z: F.when(z["b"] > z["a"], z["b"]))

    return _let(F.regexp_extract(_plain(x), ends, 0), later)


def edge_labelled(x: Column, labels: str = r"date of service|dos|visit date|service date", reach: int = 40, edge: int = 20) -> Column:
    """A date within reach characters of a label in the first or last edge words."""
    head = F.regexp_extract(x, rf"^(?:\s*+\S++){{0,{edge}}}", 0)
    tail = F.regexp_extract(x, rf"(?:\S++\s*+){{0,{edge}}}$", 0)
    p = rf"(?i)\b(?:{labels})\b[^\d\n]{{0,{reach}}}({ANY})"
    return F.coalesce(parse_any(F.regexp_extract(head, p, 1)), parse_any(F.regexp_extract(tail, p, 1)))


def print_stamps(x: Column, labels: str = "printed|print date|faxed") -> Column:
    """Dates that stand behind print words, ISO, sorted."""
    hits = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(rf"(?i)\b(?:{labels})\b[^\d\n]{{0,20}}({ANY})"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(hits, lambda h: parse_any(h).cast("string")), lambda h: h.isNotNull())))


def show_iso(x: Column) -> Column:
    """YYYY-MM-DD for dates; free text as it is."""
    return F.coalesce(parse_any(x).cast("string"), x)


def known(d: Column) -> Column:
    return F.nullif(d, F.lit(NO_DATE).cast("date"))


def dob_match(x: Column, dob: Column) -> Column:
    """Day, month and year of a birth date as neighbouring words in one of four orders; a month is a number or a word by its first three
    letters. The words are brought to one spelling first, so that each order is a plain search."""
    short = [m[:3] for m in MONTHS]
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    words = F.regexp_replace(words, rf"(?<= )(?:0+(?=[0-9])|({'|'.join(short)})[\p{{L}}\p{{N}}]+)", "$1")
    y, d = (f(dob).cast("string") for f in (F.year, F.day))
    months = (F.month(dob).cast("string"), F.get(F.array(*map(F.lit, short)), F.month(dob) - 1))

    def found(t):
        out = F.lit(False)
        for m in months:
            for o in ((m, d, y), (d, m, y), (y, m, d), (y, d, m)):
                out = out | F.contains(t, F.concat(*(z for v in o for z in (F.lit(" "), v)), F.lit(" ")))
        return out

    return F.coalesce(_let(words, found), F.lit(False))
