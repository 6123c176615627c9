"""Text normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of Latin-1 and Latin Extended-A that have an accent, and what is left without it.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćĉċčďēĕėęěĝğġģĥĩīĭįĵķĺļľńņňōŏőŕŗřśŝşšţťũūŭůűųŵŷźżž"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyaaaccccdeeeeegggghiiiijklllnnnooorrrssssttuuuuuuwyzzz"
# Texts that stand for nothing.
BLANKS = ("nan", "none", "null", "<na>", "n/a")
# All of Unicode's white space, and the four separators of ASCII.
SPACE = r"[\x1c-\x1f\p{IsWhite_Space}]"
SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# The sentinels of the published tables.
NOT_AVAILABLE, NOT_DETECTED = "No Disponible", "No Detectada"


def unaccent(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def norm_txt(c: Column) -> Column:
    """Lower case, no accents, white space collapsed; null is empty."""
    return collapse(unaccent(F.lower(F.coalesce(c, F.lit("")))))


def norm_name(c: Column) -> Column:
    """Lower-case letters and digits without accents, all else one space."""
    return F.trim(F.regexp_replace(unaccent(F.lower(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def clean(c: Column) -> Column:
    """Trimmed; null and the texts for nothing are empty."""
    return F.regexp_replace(strip(F.coalesce(c.cast("string"), F.lit(""))), f"(?i)^(?:{'|'.join(BLANKS)})\\z", "")


def norm_label(c: Column) -> Column:
    """norm_name of a cleaned value, ordinal signs read as letters."""
    return norm_name(F.translate(clean(c), "ºª°?", "oa  "))


def sanitize(c: Column) -> Column:
    """Control characters and line ends are spaces; collapsed and trimmed."""
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " "))


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, where that is what it is; else as it was."""
    latin = c.rlike("^[\\x00-\\xFF]*$")
    raw = F.encode(F.when(latin, c), "ISO-8859-1")
    fits = F.is_valid_utf8(raw.cast("string"))
    return F.coalesce(F.when(fits, F.decode(F.when(fits, raw), "UTF-8")), c)


def before(c: Column, mark: str) -> Column:
    return F.substring_index(c, mark, 1)


def mix(title: Column, text: Column, items: Column, skip_blank: bool = False) -> Column:
    """Title, text and items as one line."""
    parts = F.concat(F.array(title, text), items)
    if skip_blank:
        parts = F.filter(parts, lambda x: F.trim(x) != "")
    return F.array_join(F.transform(parts, lambda x: F.coalesce(x, F.lit(""))), " ")


def ficha_tokens(c: Column) -> Column:
    """Runs of 3 to 8 digits, each once, in order of occurrence; a star counts if a word character follows."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\b\d{3,8}\*?\b"), 0))


def ficha_digits(c: Column) -> Column:
    whole = F.regexp_extract(c, r"^\s*(\d+)(?:\.0+)?\s*$", 1)
    return F.when(whole != "", whole).otherwise(F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", ""))


def code_of(c: Column) -> Column:
    """The first standalone run of 1 to 6 digits, without leading zeros."""
    return F.regexp_replace(F.regexp_extract(c, r"(?<!\d)(\d{1,6})(?!\d)", 1), "^0+(?=.)", "")


# Fixed value: a certificate's number.
CERTIFICATE = r"(?:[A-Z]{2,5}(?:[.\s]+[A-Z]{1,5}){0,3})(?:\s*-\s*[A-Z]{2,4})?\s*-\s*\d{1,5}\s*-\s*\d{2}\s*-\s*\d{2}(?:/(?:R|R/C))?"
# Fixed value: the target and the argument of a page's postback.
POSTBACK = r"__doPostBack\('([^']+)','([^']+)'\)"


def is_certificate(c: Column) -> Column:
    return F.coalesce(c.rlike(f"(?i)^{CERTIFICATE}$"), F.lit(False))


def certificate(c: Column) -> Column:
    """The first certificate number of a text, in capitals; else empty."""
    return strip(F.regexp_extract(F.upper(F.coalesce(c, F.lit(""))), CERTIFICATE, 0))


def postback(c: Column) -> Column:
    """(target, argument) of a link's postback; null without one."""
    return F.when(c.rlike(POSTBACK), F.struct(F.regexp_extract(c, POSTBACK, 1).alias("target"), F.regexp_extract(c, POSTBACK, 2).alias("argument")))


def compose_note(*parts: Column) -> Column:
    return F.concat_ws(" | ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def format_duration(seconds: Column) -> Column:
    """1 h 2 min 3 s; hours and minutes only where there are some."""
    s = F.bround(seconds, 0).cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.concat_ws(" ", F.when(h > 0, F.concat(h.cast("string"), F.lit(" h"))), F.when((h > 0) | (m > 0), F.concat(m.cast("string"), F.lit(" min"))), F.concat((s % 60).cast("string"), F.lit(" s")))


def token_overlap(a: Column, b: Column, stop: tuple[str, ...] = ()) -> Column:
    """Shared share of the tokens of two normalised names, of the larger set; 0 without tokens."""
    words = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda x: (x != "") & ~x.isin(*stop) if stop else x != ""))
    x, y = words(a), words(b)
    n = F.greatest(F.size(x), F.size(y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / n)


def table_signature(rows: Column, n: int = 5) -> Column:
    """First rows of a table as one text, to tell whether a page has changed."""
    return F.array_join(F.transform(F.slice(rows, 1, n), lambda r: F.array_join(r, "|")), "||")
