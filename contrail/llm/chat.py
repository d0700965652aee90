"""Chat formatting with typed content parts (DataFrame functions only).

A turn's content is a list of parts (text, image, audio, document). A visitor flattens them,
in order, into the text of the turn: runs of text parts escaped as one text (so no control string
can be put together from parts), attachments as placeholders, while their references and expanded token counts are recorded beside it. Turns are joined between
control strings; the loss mask covers the texts of the trained roles.

Escaping is reversible: a backslash is doubled, and a backslash is put after the first
character of any control string (this template's or another's), so none survives in a text.

Rows are formatted where they are read; one shuffle brings the turns of a conversation
together, since its formatted text is one value (a conversation is the unit of the result).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Control strings of well-known chat templates, escaped as well (fixed values).
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
           "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>")
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Template:
    turn: str = "<|turn|>"
    body: str = "<|body|>"
    end: str = "<|end|>"
    attachments: dict = field(default_factory=lambda: {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"})
    foreign: tuple = FOREIGN
    trained: tuple = ("assistant",)
    patch: int = 28             # an image costs a token per patch of so many pixels square
    tokens_per_second: int = 25
    tokens_per_page: int = 512

    @property
    def controls(self) -> list[str]:
        return [self.turn, self.body, self.end, *self.attachments.values(), *self.foreign]

    def escape(self, text: Column) -> Column:
        heads = {}
        for c in self.controls:
            heads.setdefault(c[0], []).append(re.escape(c[1:]))
        pattern = "|".join(f"{re.escape(h)}(?=(?:{'|'.join(rest)}))" for h, rest in heads.items())
        doubled = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
        return F.regexp_replace(doubled, pattern, r"$0\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def tokens(self, part: Column) -> Column:
        """Expanded token count of an attachment (unknown sizes: one token)."""
        tiles = F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)
        n = (F.when(part["kind"] == "image", tiles).when(part["kind"] == "audio", F.ceil(part["seconds"] * self.tokens_per_second))
             .otherwise(part["pages"] * self.tokens_per_page))
        return F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("long")

    def place(self, part: Column) -> Column:
        """An attachment's placeholder; an unknown kind is a document."""
        place = F.lit(self.attachments["document"])
        for kind, text in self.attachments.items():
            place = F.when(part["kind"] == kind, F.lit(text)).otherwise(place)
        return place

    def visit(self, parts: Column) -> Column:
        """The text of a turn: neighbouring text parts are joined before they are escaped."""
        start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("text"))
        step = lambda s, p: F.when(is_text(p), F.struct(s["done"].alias("done"), F.concat(s["text"], F.coalesce(p["text"], F.lit(""))).alias("text"))).otherwise(
            F.struct(F.concat(s["done"], F.array(s["text"], self.place(p))).alias("done"), F.lit("").alias("text")))
        # Texts and placeholders in turns, a text first and last.
        whole = F.aggregate(parts, start, step, lambda s: F.concat(s["done"], F.array(s["text"])))
        return F.array_join(F.transform(whole, lambda x, i: F.when(i % 2 == 0, self.escape(x)).otherwise(x)), "")


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def text_part(text: Column) -> Column:
    """A plain text as the only part of a turn."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"),
                            *[F.lit(None).cast(kind).alias(name) for name, kind in empty.items()]))


def format_chat(rows: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """One row per conversation: id, n_turns, formatted, loss_spans (half-open byte offsets in
    ``formatted``), attachments (turn, kind, ref, tokens, in order), expanded_tokens.

    ``parts`` is array<struct<kind,text,ref,width,height,seconds,pages>>. Defined cases: NULL
    texts, roles and parts are empty; rows are ordered by turn, equal turns by role and text,
    NULL turns first, repeated rows all stay; a NULL conversation id is a conversation of its
    own; an empty table gives an empty result. Extra columns are not read.
    """
    t = template
    parts = F.coalesce(F.col(parts_col).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    role = F.coalesce(F.col(role_col), F.lit(""))
    one = (rows.select(F.col(conv_col).alias("id"), F.col(turn_col).alias("at"), role.alias("role"), parts.alias("parts"))
           .withColumn("head", F.concat(F.lit(t.turn), t.escape(F.col("role")), F.lit(t.body)))
           .withColumn("said", t.visit(F.col("parts")))
           .select("id", "at", "role", "head", "said", F.transform(F.filter("parts", lambda p: ~is_text(p)), lambda p: F.struct(
               p["kind"].alias("kind"), p["ref"].alias("ref"), t.tokens(p).alias("tokens"))).alias("sent")))
    size = F.octet_length("head") + F.octet_length("said") + len(t.end.encode())
    before = Window.partitionBy("id").orderBy("at", "role", "said").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0)) + F.octet_length("head")
    number = F.row_number().over(Window.partitionBy("id").orderBy("at", "role", "said"))
    laid = one.withColumn("n", number).withColumn("first", first)
    turns = F.sort_array(F.collect_list(F.struct("n", "at", "role", "head", "said", "first", "sent")))
    whole = laid.groupBy("id").agg(turns.alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["role"].isin(*t.trained)), lambda x: F.struct(
        x["first"].alias("first"), (x["first"] + F.octet_length(x["said"])).alias("after")))
    sent = F.flatten(F.transform("turns", lambda x: F.transform(x["sent"], lambda s: F.struct(
        x["at"].alias("turn"), s["kind"].alias("kind"), s["ref"].alias("ref"), s["tokens"].alias("tokens")))))
    return whole.select(
        F.col("id").alias(conv_col), F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["said"], F.lit(t.end))), "").alias("formatted"),
        spans.alias("loss_spans"), sent.alias("attachments"),
        F.aggregate(sent, F.lit(0).cast("long"), lambda a, s: a + s["tokens"]).alias("expanded_tokens"))


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) a formatted conversation holds; attachments stay placeholders."""
    quoted = lambda s: re.escape(s)
    chunks = F.slice(F.split(formatted, quoted(template.turn), -1), 2, 1 << 30)
    halves = F.transform(chunks, lambda c: F.split(c, quoted(template.body), 2))
    return F.transform(halves, lambda h: F.struct(
        template.unescape(h[0]).alias("role"),
        template.unescape(F.regexp_replace(h[1], quoted(template.end) + r"\z", "")).alias("text")))


def under_loss(formatted: Column, spans: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, in order; ``formatted`` as binary."""
    return F.array_join(F.transform(spans, lambda s: template.unescape(
        F.substring(formatted, (s["first"] + 1).cast("int"), (s["after"] - s["first"]).cast("int")).cast("string"))), "")
