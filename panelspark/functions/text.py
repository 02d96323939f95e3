"""String and label expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .nulls import ColumnOrName, as_col

# Text put in place of, or removed from, a model variable's name, in order.
# Only the first occurrence is replaced, except that every underscore becomes a space.
VARIABLE_NAME_RULES = [
    ("_from_outbreaks", " from countries with existing outbreak"),
    ("fao_trade_", ""),
    ("_other", " (other)"),
    ("_", " "),
    ("continent", ""),
    (
        "shared borders from countries with existing outbreak",
        "shared borders with country with existing outbreak",
    ),
]

# Display names of the three exposure variables after title case.
EXPOSURE_DISPLAY_NAMES = {
    "Shared Borders From Outbreaks": "Border Contact",
    "Ots Trade Dollars From Outbreaks": "Economic Trade",
    "Fao Livestock Heads From Outbreaks": "Livestock Imports",
}


def surrogate_id(*cols: ColumnOrName) -> Column:
    """Parts glued without separator, a missing part as the text ``NA``."""
    return F.concat_ws(
        "", *[F.coalesce(as_col(c).cast("string"), F.lit("NA")) for c in cols]
    )


def replace_first(c: ColumnOrName, find: str, put: str) -> Column:
    """Replace the first occurrence of a literal text."""
    put = put.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(as_col(c), rf"(?s)^(.*?)\Q{find}\E", f"$1{put}")


def variable_display_name(c: ColumnOrName) -> Column:
    out = as_col(c)
    for find, put in VARIABLE_NAME_RULES:
        if find == "_":
            out = F.replace(out, F.lit("_"), F.lit(" "))
        else:
            out = replace_first(out, find, put)
    return out


def title_case(c: ColumnOrName) -> Column:
    """Underscores to spaces, then a capital after each space, slash or hyphen."""
    words = F.split(F.replace(as_col(c), F.lit("_"), F.lit(" ")), r"(?<=[\s/\-])")
    return F.array_join(F.transform(words, F.initcap), "")


def recode(c: ColumnOrName, mapping: dict[str, str]) -> Column:
    """Map listed values, leave the rest."""
    c = as_col(c)
    out = c
    for old, new in mapping.items():
        out = F.when(c == old, F.lit(new)).otherwise(out)
    return out


def merge_buckets(c: ColumnOrName, members: Sequence[str], bucket: str) -> Column:
    c = as_col(c)
    return F.when(c.isin(list(members)), F.lit(bucket)).otherwise(c)


def contains(c: ColumnOrName, text: str) -> Column:
    """Literal substring test that is FALSE for NULL."""
    return F.coalesce(as_col(c).contains(text), F.lit(False))


def array_text(c: ColumnOrName) -> Column:
    """String array as a brace list, ``{"a","b"}``; NULL stays NULL."""
    quoted = F.transform(as_col(c), lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    return F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))


def split_list(text: str | None) -> list[str] | None:
    """Comma list of a request parameter; empty or missing means no restriction."""
    if text is None:
        return None
    parts = text.split(",")
    return parts if text else None
