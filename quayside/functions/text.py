"""Column functions for text: number and date forms, keys, spelling similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with marks and their plain forms, position by position.
MARKED = "àáâãäåèéêëìíîïòóôõöùúûüýÿñçăđĩũơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyyncadiuouaaaaaaaaaaaaeeeeeeeeiioooooooooooouuuuuuuyyyy"


def number(text: Column, strict: bool = False) -> Column:
    """A local number as double. Strict: points are thousands, a comma is decimal.

    Otherwise the last of point and comma is decimal, unless it is alone and three digits follow a comma.
    """
    t = F.regexp_replace(F.trim(text), r"[\s%]", "")
    comma = F.regexp_replace(F.regexp_replace(t, r"\.", ""), ",", ".")
    if strict:
        return comma.try_cast("double")
    point = F.regexp_replace(t, ",", "")
    both = t.contains(",") & t.contains(".")
    last_comma = F.length(t) - F.instr(F.reverse(t), ",") > F.length(t) - F.instr(F.reverse(t), ".")
    thousands = F.regexp_like(t, F.lit(r"^-?\d{1,3}(,\d{3})+$"))
    return F.when(both & last_comma, comma).when(both, point).when(t.contains(",") & ~thousands, comma).otherwise(point).try_cast("double")


def day(text: Column) -> Column:
    """A date in one of the usual forms."""
    forms = ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyyMMdd", "MM.yyyy")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in forms]).cast("date")


def key(text: Column) -> Column:
    """Tags out, lower case, marks off, anything else than letters and digits one blank."""
    bare = F.lower(F.regexp_replace(text, "<[^>]*>", " "))
    return F.trim(F.regexp_replace(F.translate(bare, MARKED, PLAIN), "[^a-z0-9]+", " "))


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def imo_valid(imo: Column) -> Column:
    """Seven digits whose first six, weighted 7 to 2, sum to a number that ends in the seventh."""
    t = imo.cast("string")
    total = sum((F.substring(t, k + 1, 1).try_cast("int") * (7 - k) for k in range(1, 6)), F.substring(t, 1, 1).try_cast("int") * 7)
    return F.coalesce((F.length(t) == 7) & (total % 10 == F.substring(t, 7, 1).try_cast("int")), F.lit(False))


def canonical_url(url: Column) -> Column:
    """Without scheme, www, query, fragment and closing slash, in lower case."""
    return F.regexp_replace(F.regexp_replace(F.lower(url), r"^[a-z]+://(www\.)?", ""), r"([?#].*)$|/+$", "")
