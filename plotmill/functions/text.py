"""Column functions with the semantics the operators rely on."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's `str.strip` sees it, as a class that Java and RE2 both read.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Default tokens: runs of letters, single digits, other signs.
TOKEN = r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]"
#: A word of which each run of letters begins with a capital and goes on in small letters.
TITLE_CASE = r"^\P{L}*(\p{Lu}\p{Ll}*\P{L}+)*\p{Lu}\p{Ll}*\P{L}*$"


def strip(text: Column) -> Column:
    """`text` without outer white space of any kind."""
    return F.regexp_replace(text, rf"^{WS}+|{WS}+\z", "")


def blank(text: Column) -> Column:
    """True for null and for texts of nothing but white space."""
    return F.coalesce(strip(text), F.lit("")) == ""


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    """Default token count; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0))


def draw(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that depends on nothing but `parts`."""
    return draw_bits(*parts) / F.lit(4294967296.0)


def draw_bits(*parts: Column | str | int) -> Column:
    """The 32 bits behind `draw`."""
    key = F.concat_ws("|", *(p if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def is_title(word: Column) -> Column:
    return word.rlike(TITLE_CASE)


def replace_all(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Plain replacements, one after the other."""
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it, even inside lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def lines(text: Column) -> Column:
    r"""Lines as divided by \n, \r\n or \r; a final line end opens no further line."""
    return F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n", -1)
