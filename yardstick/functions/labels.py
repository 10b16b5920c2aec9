"""Ground-truth label and rejection-reason normalisation (LBL-1..9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col_of, ustrip

# Label spellings.
TRUE_STRINGS = ["accept", "accepted", "true", "yes", "1"]
ACCEPT_LABELS = ["accepted", "accept"]
REJECT_LABELS = ["rejected", "reject"]

# Accepted-category rule of the sampler.  A split named as r-style
# treats reason "accepted" as accepted; every other split treats "" and "accept" so.
R_STYLE_ACCEPTED = ["accepted"]
S_STYLE_ACCEPTED = ["", "accept"]

ACCEPTED = "accepted"
NO_REASON = "rejected (no reason)"


def label_bool(df: DataFrame, label_col: str | None = None) -> Column:
    """LBL-1/LBL-2: ground truth as BOOLEAN.  The column is chosen by presence
    (``label`` then ``is_generation_successful``) and its rule by its type:
    booleans as they are, strings by the accept spelling list, numbers by truthiness."""
    if label_col is None:
        if "label" in df.columns:
            label_col = "label"
        elif "is_generation_successful" in df.columns:
            label_col = "is_generation_successful"
        else:
            raise ValueError(f"no ground-truth column among {df.columns}")
    dtype = df.schema[label_col].dataType
    c = F.col(label_col)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.lower(ustrip(c)).isin(*TRUE_STRINGS), F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c != F.lit(0), F.lit(False))
    return c.isNotNull()


def label_answer(label: Column | str) -> Column:
    """LBL-3: strict ``Yes``/``No``; an unknown label raises at run time."""
    n = F.lower(ustrip(col_of(label)))
    return (
        F.when(n.isin(*ACCEPT_LABELS), F.lit("Yes"))
        .when(n.isin(*REJECT_LABELS), F.lit("No"))
        .otherwise(F.raise_error(F.concat(F.lit("Unrecognised label: "), F.coalesce(col_of(label), F.lit("NULL")))))
    )


def label_answer_or_null(label: Column | str) -> Column:
    """LBL-3 without raising: NULL marks an unknown label (reported in a ``label_error`` column)."""
    n = F.lower(ustrip(col_of(label)))
    return F.when(n.isin(*ACCEPT_LABELS), F.lit("Yes")).when(n.isin(*REJECT_LABELS), F.lit("No"))


def label_lenient(label: Column | str) -> Column:
    """LBL-4: ``accepted`` when the label is accept/accepted, else ``rejected`` (NULL too)."""
    n = F.lower(ustrip(F.coalesce(col_of(label), F.lit(""))))
    return F.when(n.isin(*ACCEPT_LABELS), F.lit("accepted")).otherwise(F.lit("rejected"))


def reason_text(reason: Column | str) -> Column:
    """LBL-5: stripped reason, NULL/empty -> ''."""
    return F.coalesce(ustrip(col_of(reason)), F.lit(""))


def sampling_category(reason: Column | str, split: Column | str, r_style_splits: list[str]) -> Column:
    """LBL-6: ``accepted`` when the raw reason is in the split's accepted set, else the reason."""
    r, s = col_of(reason), col_of(split)
    r_style = s.isin(*r_style_splits) if r_style_splits else F.lit(False)
    accepted = F.when(r_style, r.isin(*R_STYLE_ACCEPTED)).otherwise(r.isin(*S_STYLE_ACCEPTED))
    return F.when(F.coalesce(accepted, F.lit(False)), F.lit(ACCEPTED)).otherwise(r)


def eval_bucket(is_positive: Column | str, reason: Column | str) -> Column:
    """LBL-7: positive -> ``accepted``; negative -> stripped reason, or ``rejected (no reason)``."""
    return F.when(col_of(is_positive), F.lit(ACCEPTED)).otherwise(
        F.coalesce(F.nullif(reason_text(reason), F.lit("")), F.lit(NO_REASON))
    )


def report_field(c: Column | str, default: str = "") -> Column:
    """LBL-8: metadata projection with a default for NULL."""
    return F.coalesce(col_of(c), F.lit(default))
