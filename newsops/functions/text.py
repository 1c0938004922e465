"""Text expressions (Column -> Column) with Python string semantics.

Whitespace is Python's ``str.isspace`` set; letters and numbers are Unicode
general categories.  No Python worker is involved."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Python's whitespace set, as characters (for trimming) and as a regex class.
WS_CHARS = "".join(
    chr(i)
    for i in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WS_CLASS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WS_CHARS))


def is_blank(c: Column | str) -> Column:
    """True for null and for whitespace-only text."""
    return F.coalesce(strip(c) == "", F.lit(True))


def not_blank(c: Column | str) -> Column:
    return ~is_blank(c)


def non_empty(c: Column | str) -> Column:
    """Null for the empty string, else the value."""
    return F.nullif(col(c), F.lit(""))


def first_non_empty(*cols: Column | str, default: str | None = None) -> Column:
    """First column that is neither null nor empty; without any, the last
    column as it is (possibly empty), or ``default`` when that is null."""
    *head, last = [col(c) for c in cols]
    parts = [non_empty(c) for c in head] + [last]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def article_hash(c: Column | str) -> Column:
    """Fingerprint: lower, strip, keep alphanumerics and whitespace, md5."""
    kept = F.regexp_replace(strip(F.lower(col(c))), rf"[^\p{{L}}\p{{N}}{WS_CLASS}]+", "")
    return F.md5(kept)


def compose(title: Column | str, body: Column | str, style: str = "article") -> Column:
    """``article``: "title. body" stripped.  ``optional``: the title alone when
    there is no body.  ``plain``: "title body" stripped."""
    t, b = F.coalesce(col(title), F.lit("")), F.coalesce(col(body), F.lit(""))
    if style == "plain":
        return strip(F.concat(t, F.lit(" "), b))
    joined = strip(F.concat(t, F.lit(". "), b))
    if style == "optional":
        return F.when(b != "", joined).otherwise(t)
    return joined


def summary(c: Column | str, size: int = 200) -> Column:
    c = col(c)
    return F.when(F.length(c) > size, F.concat(F.left(c, F.lit(size)), F.lit("..."))).otherwise(c)


def model_input(c: Column | str, size: int = 512) -> Column:
    """What the plugged-in model is given: it reads at most ``size`` characters."""
    return F.left(col(c), F.lit(size))


def min_content(title, content, min_title: int = 20, min_content: int = 100) -> Column:
    return (F.length(col(title)) >= min_title) & (F.length(col(content)) >= min_content)


def longer_than(c: Column | str, size: int = 50) -> Column:
    return F.length(col(c)) > size


def is_upper(c: Column | str) -> Column:
    """``str.isupper``: some cased character and none lower- or title-case."""
    c = col(c)
    return c.rlike(r"\p{IsUppercase}") & ~c.rlike(r"[\p{IsLowercase}\p{Lt}]")


def has_suspicious(c: Column | str) -> Column:
    """Any character outside word characters, whitespace and common punctuation."""
    allowed = r"\p{L}\p{N}_" + WS_CLASS + r".,!?\"'\-():;%$+=&@#"
    return col(c).rlike(f"[^{allowed}]")


def py_title(c: Column | str) -> Column:
    """``str.title``: every run of cased characters is capitalised."""
    runs = F.regexp_extract_all(col(c), F.lit(f"[{CASED}]+|[^{CASED}]+"), F.lit(0))
    capital = F.transform(
        runs,
        lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substring(r, 2, 2**31 - 1))),
    )
    return F.array_join(capital, "")


def smart_truncate(c: Column | str, size: int = 512) -> Column:
    """Cut to ``size``: after the last '.', else before the last space, when
    that lies beyond 80 % of ``size``; else a hard cut."""
    def cut(p):
        dot = F.length(p) - F.length(F.substring_index(p, ".", -1)) - 1
        space = F.length(p) - F.length(F.substring_index(p, " ", -1)) - 1
        return (
            F.when(dot > size * 0.8, F.left(p, dot + 1))
            .when(space > size * 0.8, F.left(p, space))
            .otherwise(p)
        )

    c = col(c)
    return F.when(F.length(c) > size, let(F.left(c, F.lit(size)), cut)).otherwise(c)


def clean_text(c: Column | str, size: int = 512) -> Column:
    """Collapse whitespace and doubled quotes, calm shouted text, truncate, strip."""
    c = F.coalesce(col(c), F.lit(""))
    flat = F.regexp_replace(F.regexp_replace(c, f"[{WS_CLASS}]+", " "), '""', '"')
    calm = let(flat, lambda t: F.when(is_upper(t) & (F.length(t) > 50), py_title(t)).otherwise(t))
    return let(calm, lambda t: strip(smart_truncate(t, size)))
