"""Chat-format training examples (CHT-1..6) as ``Column`` expressions.

The example layout follows the reference: a user turn holding two images and the
prompt, and an assistant turn holding ``<reasoning>...</reasoning>`` and the
Yes/No answer.  Prompt and reasoning templates are caller parameters.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

ITEM_TYPE = "struct<type:string,text:string,image:binary>"


def _item(type_: str, text: Column | None = None, image: Column | None = None) -> Column:
    return F.struct(
        F.lit(type_).alias("type"),
        (text if text is not None else F.lit(None).cast("string")).alias("text"),
        (image if image is not None else F.lit(None).cast("binary")).alias("image"),
    )


def assistant_text(reasoning: Column, answer: Column) -> Column:
    """CHT-5: ``<reasoning>\\n{reasoning}\\n</reasoning>\\n\\n{answer}``."""
    return F.concat(F.lit("<reasoning>\n"), reasoning, F.lit("\n</reasoning>\n\n"), answer)


def fill(template: str, **values: Column) -> Column:
    """Render a ``{name}`` template with column values as one ``concat``."""
    out = []
    for part in re.split(r"(\{\w+\})", template):
        m = re.fullmatch(r"\{(\w+)\}", part)
        if m and m.group(1) in values:
            out.append(values[m.group(1)])
        elif part:
            out.append(F.lit(part))
    return F.concat(*out) if out else F.lit("")


def accepted_reasoning(description: Column | str, template: str, default_description: str = "a product") -> Column:
    """CHT-3: accepted-pair reasoning; a NULL description falls back to the default."""
    return fill(template, desc=F.coalesce(col_of(description), F.lit(default_description)))


def rejected_reasoning(
    description: Column | str,
    reason: Column | str,
    rule_text: Column | str,
    template: str,
    default_rule: str = "Rejected for: {reason}.",
    default_description: str = "a product",
) -> Column:
    """CHT-4: rejected-pair reasoning; ``rule_text`` comes from the rules lookup (JON-7),
    an unknown reason gets ``default_rule``."""
    r = F.coalesce(col_of(reason), F.lit(""))
    rule = F.coalesce(col_of(rule_text), fill(default_rule, reason=r))
    return fill(template, desc=F.coalesce(col_of(description), F.lit(default_description)), reason=r, rule=rule)


def example_messages(image_a: Column, image_b: Column, prompt: str, assistant: Column) -> Column:
    """CHT-1: ``[{role: user, content: [image, image, text]}, {role: assistant, content: [text]}]``."""
    user = F.struct(
        F.lit("user").alias("role"),
        F.array(_item("image", image=image_a), _item("image", image=image_b), _item("text", text=F.lit(prompt))).alias("content"),
    )
    bot = F.struct(F.lit("assistant").alias("role"), F.array(_item("text", text=assistant)).alias("content"))
    return F.array(user, bot)


def message_images(messages: Column | str) -> Column:
    """CHT-6: the images of all messages in order, skipping non-image items and
    content that is not a list (NULL content)."""
    m = col_of(messages)
    per_msg = F.transform(
        m, lambda msg: F.coalesce(F.filter(msg["content"], lambda c: c["type"] == F.lit("image")), F.array().cast(f"array<{ITEM_TYPE}>"))
    )
    return F.transform(F.flatten(per_msg), lambda c: c["image"])
