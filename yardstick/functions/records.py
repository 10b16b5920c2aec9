"""Record parsing for raw batch-inference output lines (PRJ-1..13).

A raw line is parsed once with ``from_json`` into the few top-level fields the engine
reads; the echoed input (images included) is skipped by the parser, not copied, and no
line is too long.  Every field but ``error`` is text, so a field of an unexpected type
never spoils its line; nested fields are read from that text, lists element by element,
so an odd element never spoils its neighbours.  A key given twice counts with its last
value and ``NaN`` is accepted, as in the reference's parser.

One strict value per line: the text is parsed inside an object of our own, followed by a
closing field.  Single quotes, text after the value, a second value or a stray bracket
break that object or end it early; the closing field is then missing and the line is
malformed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, regex_quote, truthy_json

# Drop reasons reported by the parse-error accounting.
DROP_MALFORMED = "malformed"
DROP_NO_ID = "no_record_id"
DROP_ID_RANGE = "record_id_out_of_range"
DROP_ERROR = "error_record"
DROP_NO_CONTENT = "no_content"


_VALUE, _END = "_value", "_end"
_LINE = "payload string, recordId string, record_id string, SageMakerOutput string, modelOutput string, error variant"


def strict_object(text: Column, fields: str) -> Column:
    """Text -> struct of ``_value`` (the fields, NULL unless the text is a JSON object) and
    ``_end`` (NULL unless the text is exactly one JSON value)."""
    inside = F.concat(F.lit('{"%s":' % _VALUE), text, F.lit(',"%s":0}' % _END))
    return F.from_json(inside, f"{_VALUE} struct<{fields}>, {_END} int", {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})


def parse_line(value: Column | str) -> Column:
    """Line text -> struct of the fields read from it (SRC-5); see ``malformed``."""
    return strict_object(col_of(value), _LINE)


def malformed(v: Column) -> Column:
    """True for a line that is not exactly one JSON object."""
    return v[_END].isNull() | v[_VALUE].isNull()


def field(v: Column, name: str) -> Column:
    """A field of a parsed object."""
    return v[_VALUE][name]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def record_id(v: Column) -> Column:
    """PRJ-1: ``payload.record_id`` -> ``recordId`` -> ``record_id``; empty counts as missing."""
    return F.coalesce(
        _nonempty(F.from_json(field(v, "payload"), "record_id string")["record_id"]),
        _nonempty(field(v, "recordId")),
        _nonempty(field(v, "record_id")),
    )


_ID = r"sample_(\d+)"


def sample_index(rid: Column) -> Column:
    """PRJ-2: integer after the first ``sample_``; NULL when there is none (or it overflows)."""
    return F.regexp_extract(rid, _ID, 1).try_cast("bigint")


def chat_content(v: Column) -> Column:
    """PRJ-3: ``SageMakerOutput.choices[0].message.content``, whatever the other choices are."""
    first = F.get(F.from_json(field(v, "SageMakerOutput"), "choices array<string>")["choices"], 0)
    return F.from_json(first, "message struct<content: string>")["message"]["content"]


def block_content(v: Column) -> Column:
    """PRJ-4: ``modelOutput`` (object, or a JSON string holding exactly one) ``.content``;
    the text of the first block that has ``type = 'text'`` or a ``text`` key.  Blocks that
    are no objects are passed over."""
    output = strict_object(field(v, "modelOutput"), "content array<string>")  # an object and a string holding one read alike
    blocks = _let(output, lambda o: F.when(o[_END].isNotNull(), o[_VALUE]["content"]))
    objects = F.transform(blocks, lambda b: F.struct(F.from_json(b, "type string, text string").alias("b"), F.json_object_keys(b).alias("keys")))
    chosen = F.filter(objects, lambda o: (o["b"]["type"] == F.lit("text")) | F.array_contains(o["keys"], "text"))
    return F.get(chosen, 0)["b"]["text"]


def content(v: Column) -> Column:
    """PRJ-5: chat shape first, block shape only when that is empty."""
    return F.coalesce(_nonempty(chat_content(v)), block_content(v))


def is_error_record(v: Column, text: Column) -> Column:
    """PRJ-6: no content and a truthy ``error`` field."""
    no_content = F.coalesce(text, F.lit("")) == F.lit("")
    return no_content & truthy_json(field(v, "error"))


def drop_reason(v: Column, sample: Column, text: Column) -> Column:
    """AGG-11: why a line yields no prediction, NULL when it yields one (order as the
    reference checks).  An id beyond BIGINT has a reason of its own."""
    return (
        F.when(malformed(v), F.lit(DROP_MALFORMED))
        .when(sample.isNull() & F.regexp_like(record_id(v), F.lit(_ID)), F.lit(DROP_ID_RANGE))
        .when(sample.isNull(), F.lit(DROP_NO_ID))
        .when(is_error_record(v, text), F.lit(DROP_ERROR))
        .when(F.coalesce(text, F.lit("")) == F.lit(""), F.lit(DROP_NO_CONTENT))
    )


def batch_path(source_file: Column | str, input_prefix: str) -> Column:
    """PRJ-8: ``<last folder of prefix>/<path relative to prefix>`` with the two fallbacks."""
    f = col_of(source_file)
    prefix = input_prefix.rstrip("/") + "/"
    folder = input_prefix.rstrip("/").split("/")[-1]
    relative = F.coalesce(
        F.when(f.startswith(F.lit(prefix)), F.substr(f, F.lit(len(prefix) + 1))),
        _nonempty(F.regexp_extract(f, "(?s)" + regex_quote(folder) + "/(.*)", 1)),
        _nonempty(F.regexp_extract(f, r"(?s)s3://[^/]+/[^/]+/(.*)", 1)),
        f,
    )
    return F.concat(F.lit(folder + "/"), relative)


def path_segment(path: Column | str, i: int) -> Column:
    """``path.split('/')[i]`` or ``'unknown'`` when there are too few segments (PRJ-9, PRJ-10)."""
    return F.coalesce(F.get(F.split(col_of(path), "/"), i), F.lit("unknown"))


def dataset_name(path: Column | str) -> Column:
    """PRJ-9 (empty or NULL batch_path -> ``unknown``)."""
    p = col_of(path)
    return F.when(F.coalesce(p, F.lit("")) == "", F.lit("unknown")).otherwise(path_segment(p, 1))


def model_name(path: Column | str) -> Column:
    """PRJ-10."""
    p = col_of(path)
    return F.when(F.coalesce(p, F.lit("")) == "", F.lit("unknown")).otherwise(path_segment(p, 2))


def batch_number(source_file: Column | str) -> Column:
    """PRJ-11: first ``batch_(\\d+)`` in the file path, else 0."""
    return F.coalesce(F.regexp_extract(col_of(source_file), r"batch_(\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def normalized_prediction(pred: Column | str) -> Column:
    """PRJ-12: lower + strip, kept only when it is ``yes`` or ``no``."""
    from .text import ustrip

    p = F.lower(ustrip(col_of(pred)))
    return F.when(p.isin("yes", "no"), p)


def directory_dataset(output_dir: str) -> Column:
    """PRJ-13: raw files without batch_path take the output directory's name."""
    return F.lit(output_dir.rstrip("/").split("/")[-1])
