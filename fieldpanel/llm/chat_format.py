"""Chat formatting of typed content parts.

A turn's content is an ordered list of parts (text, image, audio, document). A visitor
flattens it: text is escaped, every attachment becomes one placeholder in its place, and
the attachment's reference and the number of tokens that it expands to are recorded.
Turns are framed by markers and joined into one string per conversation; the loss mask
is a list of spans (code points of that string) over the assistant's content.

Control strings inside texts and roles are escaped by one backslash after their first
character; control strings that already hold backslashes there gain one. Unescaping takes
one away, so any text is restored exactly and no marker can be forged.

Defined results: null content, parts, texts and roles count as empty; parts of an unknown
type are kept as a generic attachment with no tokens; turns are ordered by number (null
first), then by role and content, so repeated turns are all kept in a fixed order; turns
with a null conversation id form one conversation; an empty table gives no rows; extra
columns are not read. One conversation is one string, so it has to fit in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PLACEHOLDERS = {
    "image": "<|image|>",
    "audio": "<|audio|>",
    "document": "<|document|>",
    "other": "<|attachment|>",
}

# Control strings of common chat templates, without their first character.
CONTROL_TAILS = [
    r"\|[A-Za-z_]+\|>",
    r"/?s>",
    r"</?SYS>>",
    r"/?INST\]",
]
_TAIL = "(" + "|".join(CONTROL_TAILS) + ")"
ESCAPE = r"([<\[])(\\*)" + _TAIL
UNESCAPE = r"([<\[])(\\*)\\" + _TAIL

PART_TYPE = (
    "array<struct<type:string,text:string,uri:string,width:int,height:int,"
    "seconds:double,pages:int>>"
)

# Expansion of attachments: an image costs a base and one amount per tile, audio an
# amount per second, a document an amount per page.
IMAGE_TILE, IMAGE_BASE_TOKENS, IMAGE_TILE_TOKENS = 512, 85, 170
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 800
WORD = r"[^\x20\x09-\x0D]+"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def _empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _kind(part: Column) -> Column:
    known = F.when(part["type"].isNull() | (part["type"] == "text"), "text")
    for kind in ("image", "audio", "document"):
        known = known.when(part["type"] == kind, kind)
    return known.otherwise("other")


def _tokens(part: Column) -> Column:
    def tiles(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / IMAGE_TILE)

    image = IMAGE_BASE_TOKENS + IMAGE_TILE_TOKENS * tiles("width") * tiles("height")
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_PER_SECOND)
    pages = F.coalesce(part["pages"], F.lit(0)) * DOCUMENT_TOKENS_PER_PAGE
    kind = _kind(part)
    return (
        F.when(kind == "text", F.regexp_count(_empty(part["text"]), F.lit(WORD)))
        .when(kind == "image", image)
        .when(kind == "audio", audio)
        .when(kind == "document", pages)
        .otherwise(0)
        .cast("bigint")
    )


def visit(parts: Column) -> Column:
    """Flatten content parts: struct(kind, raw, uri, tokens) each, in order.

    ``raw`` is the text as it is, or the attachment's placeholder.
    """

    def one(part: Column) -> Column:
        kind = _kind(part)
        raw = F.when(kind == "text", _empty(part["text"]))
        for name, placeholder in PLACEHOLDERS.items():
            raw = raw.when(kind == name, placeholder)
        return F.struct(
            kind.alias("kind"), raw.alias("raw"), part["uri"].alias("uri"),
            _tokens(part).alias("tokens"),
        )

    return F.transform(F.coalesce(parts, F.array().cast(PART_TYPE)), one)


def body_of(parts: Column) -> Column:
    """Visited parts as one string. Adjacent texts are joined before they are escaped, so that
    no control string can be put together from pieces."""
    run = "struct<plain:boolean,raw:string>"

    def add(runs: Column, part: Column) -> Column:
        plain, last = part["kind"] == "text", F.try_element_at(runs, F.lit(-1))
        longer = F.struct(
            F.lit(True).alias("plain"), F.concat(last["raw"], part["raw"]).alias("raw")
        ).cast(run)
        new = F.struct(plain.alias("plain"), part["raw"].alias("raw")).cast(run)
        grown = F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(longer))
        return F.when(plain & F.coalesce(last["plain"], F.lit(False)), grown).otherwise(
            F.concat(runs, F.array(new))
        )

    runs = F.aggregate(parts, F.array().cast(f"array<{run}>"), add)
    written = F.transform(runs, lambda r: F.when(r["plain"], escape(r["raw"])).otherwise(r["raw"]))
    return F.when(F.size(parts) > 1, F.array_join(written, "")).otherwise(
        F.array_join(
            F.transform(
                parts, lambda p: F.when(p["kind"] == "text", escape(p["raw"])).otherwise(p["raw"])
            ),
            "",
        )
    )


def text_part(text: Column) -> Column:
    """Content of one text part."""
    empty = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in empty.items()],
    )
    return F.array(part)


def format_conversations(
    turns: DataFrame,
    content: Column,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss, attachments, tokens.

    ``loss`` is array<struct<start, end>>; ``attachments`` is array<struct<turn, part, kind,
    uri, tokens>> in order of the placeholders; ``tokens`` counts words of text parts and
    expanded attachments.
    """
    name = _empty(F.col(role))
    seen = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        name.alias("role"),
        visit(content).alias("parts"),
    )
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEPARATOR))
    body = body_of(F.col("parts"))
    rendered = seen.withColumns({"head": head, "body": body}).select(
        "conv_id", "turn", "role",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.length("head").alias("skip"),
        F.length("body").alias("length"),
        F.filter(
            F.transform(
                "parts",
                lambda p, i: F.struct(
                    F.col("turn").alias("turn"), i.alias("part"), p["kind"].alias("kind"),
                    p["uri"].alias("uri"), p["tokens"].alias("tokens"),
                ),
            ),
            lambda p: p["kind"] != "text",
        ).alias("attachments"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["tokens"]).alias("tokens"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece")
    order = order.rowsBetween(Window.unboundedPreceding, 0)
    at = F.sum(F.length("piece") + 1).over(order) - F.length("piece") - 1
    whole = (
        rendered.withColumn("at", at)
        .groupBy("conv_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("at", "piece", "skip", "length", "role", "attachments"))
            ).alias("turns"),
            F.sum("tokens").alias("tokens"),
        )
    )
    masked = F.filter("turns", lambda t: t["role"] == loss_role)
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "\n").alias("formatted"),
        F.transform(
            masked,
            lambda t: F.struct(
                (t["at"] + t["skip"]).alias("start"),
                (t["at"] + t["skip"] + t["length"]).alias("end"),
            ),
        ).alias("loss"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
        "tokens",
    )


def _pattern(marker: str) -> str:
    return marker.replace("|", r"\|")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.split(formatted, _pattern(START))
    pieces = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    fields = F.transform(pieces, lambda p: F.split(p, f"{_pattern(SEPARATOR)}|{_pattern(END)}"))
    return F.transform(
        fields,
        lambda f: F.struct(unescape(f[0]).alias("role"), unescape(f[1]).alias("text")),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask."""
    texts = F.transform(
        loss,
        lambda s: unescape(
            F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return F.array_join(texts, "")
