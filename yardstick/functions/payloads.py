"""Inference payload builders (BAT-6..18) as native ``Column`` expressions.

A payload is a ``to_json(struct(...))``: the per-row dict building and
``json.dumps`` of the reference become one projection inside codegen.  NULL
struct fields are omitted by ``to_json``, which gives each content block its own
shape from a single struct type.  Prompt texts are caller parameters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# Request constants of the four model families.
ANTHROPIC_VERSION = "bedrock-2023-05-31"
MAX_TOKENS = 20000
LLAMA_USER_HEAD = "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\n"
LLAMA_ASSISTANT_HEAD = "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
LLAMA_IMAGE = "<|image|>"
MISTRAL_OPEN = "<s>[INST] \n"
MISTRAL_CLOSE = " [/INST]"

# Image media types by file extension (default image/jpeg).
MEDIA_TYPES = {
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".gif": "image/gif",
    ".bmp": "image/bmp",
    ".webp": "image/webp",
}


def b64(data: Column | str) -> Column:
    """BAT-14: standard base64 without line breaks (Spark's ``base64`` may chunk)."""
    return F.replace(F.base64(col_of(data)), F.lit("\r\n"), F.lit(""))


def data_uri(data: Column | str, mime: Column | str = "image/jpeg") -> Column:
    m = F.lit(mime) if isinstance(mime, str) else mime
    return F.concat(F.lit("data:"), m, F.lit(";base64,"), b64(data))


def mime_type(path: Column | str) -> Column:
    """BAT-15: media type from the lowered file suffix, default ``image/jpeg``."""
    name = F.regexp_extract(col_of(path), r"[^/]*$", 0)
    ext = F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))
    lookup = F.create_map(*[F.lit(x) for kv in MEDIA_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, ext), F.lit("image/jpeg"))


def part_label(key: str) -> str:
    """BAT-16: ``[Title Cased Key]`` for an image column name."""
    return "[" + key.replace("_", " ").title() + "]"


def part_label_col(key: Column | str) -> Column:
    return F.concat(F.lit("["), F.initcap(F.replace(col_of(key), F.lit("_"), F.lit(" "))), F.lit("]"))


def _block(type_=None, text=None, source=None, image=None) -> Column:
    null = F.lit(None)
    return F.struct(
        (F.lit(type_) if type_ else null.cast("string")).alias("type"),
        (text if text is not None else null.cast("string")).alias("text"),
        (source if source is not None else null.cast("struct<type:string,media_type:string,data:string>")).alias("source"),
        (image if image is not None else null.cast("struct<format:string,source:struct<bytes:string>>")).alias("image"),
    )


def claude_content(images: list[tuple[str, Column]], prompt: str, media: str = "image/jpeg") -> Column:
    """BAT-7 content: a label text block and a base64 image block per image, then the prompt."""
    blocks = []
    for key, data in images:
        blocks.append(_block("text", F.lit(part_label(key))))
        src = F.struct(F.lit("base64").alias("type"), F.lit(media).alias("media_type"), b64(data).alias("data"))
        blocks.append(_block("image", source=src))
    blocks.append(_block("text", F.lit(prompt)))
    return F.array(*blocks)


def nova_content(images: list[tuple[str, Column]], prompt: str) -> Column:
    """BAT-8 content: ``{text}`` and ``{image: {format, source: {bytes}}}`` blocks."""
    blocks = []
    for key, data in images:
        blocks.append(_block(text=F.lit(part_label(key))))
        img = F.struct(F.lit("jpeg").alias("format"), F.struct(b64(data).alias("bytes")).alias("source"))
        blocks.append(_block(image=img))
    blocks.append(_block(text=F.lit(prompt)))
    return F.array(*blocks)


def _messages_envelope(record_id: Column, content: Column) -> Column:
    msg = F.struct(F.lit("user").alias("role"), content.alias("content"))
    body = F.struct(
        F.lit(ANTHROPIC_VERSION).alias("anthropic_version"),
        F.lit(MAX_TOKENS).alias("max_tokens"),
        F.array(msg).alias("messages"),
    )
    return F.to_json(F.struct(record_id.alias("recordId"), body.alias("modelInput")))


def llama_prompt(images: list[tuple[str, Column]], prompt: str) -> Column:
    """BAT-9 prompt string."""
    parts: list[Column] = [F.lit(LLAMA_USER_HEAD)]
    for key, data in images:
        parts += [F.lit(part_label(key) + "\n" + LLAMA_IMAGE), b64(data), F.lit("\n")]
    parts += [F.lit(prompt), F.lit(LLAMA_ASSISTANT_HEAD)]
    return F.concat(*parts)


def mistral_prompt(images: list[tuple[str, Column]], prompt: str) -> Column:
    """BAT-10 prompt string."""
    parts: list[Column] = [F.lit(MISTRAL_OPEN)]
    for i, (key, data) in enumerate(images):
        parts += [F.lit(part_label(key) + ": "), b64(data), F.lit(",\n" if i < len(images) - 1 else "\n")]
    parts += [F.lit(prompt), F.lit(MISTRAL_CLOSE)]
    return F.concat(*parts)


def _prompt_envelope(record_id: Column, prompt: Column, limit_key: str) -> Column:
    body = F.struct(prompt.alias("prompt"), F.lit(MAX_TOKENS).alias(limit_key))
    return F.to_json(F.struct(record_id.alias("recordId"), body.alias("modelInput")))


def model_family(model_id: str) -> str:
    """BAT-6 routing rule on the model id."""
    if model_id == "" or "claude" in model_id:
        return "claude"
    if "nova" in model_id or "qwen" in model_id:
        return "nova"
    if "meta" in model_id:
        return "llama"
    if "mistral" in model_id:
        return "mistral"
    return "unknown"


def family_col(model_id: Column) -> Column:
    """BAT-6 as a per-row expression when the model id is data."""
    return (
        F.when((model_id == "") | model_id.contains("claude"), F.lit("claude"))
        .when(model_id.contains("nova") | model_id.contains("qwen"), F.lit("nova"))
        .when(model_id.contains("meta"), F.lit("llama"))
        .when(model_id.contains("mistral"), F.lit("mistral"))
        .otherwise(F.lit("unknown"))
    )


def payload(record_id: Column, images: list[tuple[str, Column]], prompt: str, family: str) -> Column:
    """One JSON line per record for a model family (BAT-6..10, BAT-13).  Nova/Qwen content
    travels in the Claude envelope.  A record that lacks an image, or whose family has no
    builder, gets no line (NULL); ``payload_error`` says why."""
    if family == "claude":
        line = _messages_envelope(record_id, claude_content(images, prompt))
    elif family == "nova":
        line = _messages_envelope(record_id, nova_content(images, prompt))
    elif family == "llama":
        line = _prompt_envelope(record_id, llama_prompt(images, prompt), "max_gen_len")
    elif family == "mistral":
        line = _prompt_envelope(record_id, mistral_prompt(images, prompt), "max_tokens")
    else:
        return F.lit(None).cast("string")
    return F.when(required_images_error(images).isNull(), line)


def payload_error(images: list[tuple[str, Column]], family: Column) -> Column:
    """Why a record has no payload line, NULL when it has one (BAT-6, BAT-18)."""
    no_builder = F.concat(F.lit("no payload builder for family "), family)
    return F.when(family == F.lit("unknown"), no_builder).otherwise(required_images_error(images))


def routed_payload(record_id: Column, images: list[tuple[str, Column]], prompt: str, model_id: Column) -> Column:
    """BAT-6 when the model id varies per row: every family's builder behind one CASE."""
    fam = family_col(model_id)
    out = F.lit(None).cast("string")
    for f in ("claude", "nova", "llama", "mistral"):
        out = F.when(fam == f, payload(record_id, images, prompt, f)).otherwise(out)
    return out


def chat_payload(
    images: list[tuple[str, Column]],
    prompt: str,
    system_prompt: str,
    max_tokens: int = 1024,
    temperature: float = 0.8,
    top_p: float = 0.8,
    presence_penalty: float = 1.5,
) -> Column:
    """BAT-11: OpenAI-style chat body as JSON text; absent (NULL) images are skipped.
    The system turn (string content) and user turn (list content) differ in shape, so
    each turn is written as its own JSON text and the body is assembled from them: the
    images are serialised once and never parsed, whatever their size."""
    parts = []
    for label, data in images:
        text = F.struct(F.lit("text").alias("type"), F.lit(f"\n**{label}**").alias("text"), F.lit(None).cast("struct<url:string>").alias("image_url"))
        img = F.struct(
            F.lit("image_url").alias("type"),
            F.lit(None).cast("string").alias("text"),
            F.struct(data_uri(data).alias("url")).alias("image_url"),
        )
        parts += [F.when(data.isNotNull(), text), F.when(data.isNotNull(), img)]
    parts.append(F.struct(F.lit("text").alias("type"), F.lit(prompt).alias("text"), F.lit(None).cast("struct<url:string>").alias("image_url")))
    content = F.filter(F.array(*parts), lambda x: x.isNotNull())
    user = F.to_json(F.struct(F.lit("user").alias("role"), content.alias("content")))
    system = F.to_json(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")))
    settings = F.to_json(
        F.struct(
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
            F.lit(top_p).alias("top_p"),
            F.lit(presence_penalty).alias("presence_penalty"),
        )
    )
    return F.concat(F.lit('{"messages":['), system, F.lit(","), user, F.lit("],"), F.substr(settings, F.lit(2)))


def envelope(record_id: Column, payload_json: Column, ground_truth: Column | None = None) -> Column:
    """BAT-12: ``{record_id, payload, ground_truth?}`` (ground truth only when the column exists)."""

    def member(name: str, value: Column) -> Column:  # '"name":value', NULL for a NULL value
        text = F.to_json(F.struct(value.alias(name)))
        return F.when(value.isNotNull(), F.substr(text, F.lit(2), F.length(text) - 2))

    members = [member("record_id", record_id), F.concat(F.lit('"payload":'), payload_json)]
    if ground_truth is not None:
        members.append(member("ground_truth", ground_truth))
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def required_images_error(images: list[tuple[str, Column]]) -> Column:
    """BAT-18: the first missing required image as an error message, NULL when all present."""
    out = F.lit(None).cast("string")
    for key, data in reversed(images):
        out = F.when(data.isNull(), F.lit(f"no image in {key}")).otherwise(out)
    return out


def label_list_text(header: str, labels: list[tuple[str, Column | str]]) -> Column:
    """BAT-17: the label list rendered into prompt text, in enum order."""
    lines = [F.lit(header)]
    for name, desc in labels:
        d = F.lit(desc) if isinstance(desc, str) else desc
        lines.append(F.concat(F.lit(f"- '{name}': "), d))
    return F.concat_ws("\n", *lines)
