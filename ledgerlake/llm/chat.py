"""Chat formatting: conversations rebuilt from an event log, then rendered with a loss mask.

Everything is DataFrame functions. The log has one row per event: conversation, sequence
number, kind, message, role, text. In the order of sequence numbers,

* ``append`` begins a message with a text (none: empty),
* ``delta`` adds a text to the message, and begins it where it wasn't begun,
* ``edit`` replaces the message's text,
* ``regenerate`` empties the message and takes back all messages that began after it and
  before this event; deltas that follow make its new text.

The log is partitioned by conversation once; windows over it find each message's last reset and
what a later regeneration takes back; what is left is joined in order. A rendered conversation
is one string, so a conversation is the unit that one task ends with.

Rendering marks each turn as ``<|im_start|>role<|im_sep|>text<|im_end|>``. Inside roles and
texts a backslash is doubled, and a control string gets a backslash after its first character:
no control string is left in them, and dropping those backslashes gives the text back.

Rows: null texts and roles are empty. Rows with equal sequence numbers go by kind (in the order
above), message, role, text, null first; repeated appends are messages of their own; an edit or
regeneration of a message that never began does nothing. Null conversations, sequence numbers
and messages are values like others, null first. Other kinds, null too, are ignored. An empty
table gives an empty table. Columns are taken by name and others are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's marks, and further control strings that texts must not spell.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
KINDS = ("append", "delta", "edit", "regenerate")
_CONTROL = "(" + "|".join(rf"\Q{c[0]}\E(?=\Q{c[1:]}\E)" for c in CONTROLS) + ")"


def escaped(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def reconstruct(log: DataFrame, conv: str = "conv_id", seq: str = "seq", kind: str = "kind", message: str = "message", role: str = "role", text: str = "text") -> DataFrame:
    """Final messages: conv_id, at (their order in the conversation), role, text."""
    rank = F.coalesce(*[F.when(F.col(kind) == k, F.lit(n)) for n, k in enumerate(KINDS)])
    e = log.select(F.col(conv).alias("conv_id"), F.col(seq).alias("seq"), rank.alias("kind"), F.col(message).alias("message"), F.col(role).alias("role"), F.col(text).alias("text")).where("kind IS NOT NULL")
    order = ["seq", "kind", "message", "role", "text"]
    e = e.withColumn("pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    same = Window.partitionBy("conv_id", "message").orderBy("pos")
    so_far = same.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Which of the appends to one message name an event belongs to.
    e = e.withColumn("version", F.sum((F.col("kind") == 0).cast("long")).over(so_far))
    own = Window.partitionBy("conv_id", "message", "version")
    e = e.withColumns(
        {
            "began": F.min(F.when(F.col("kind") <= 1, F.col("pos"))).over(own),
            "redone": F.max(F.when(F.col("kind") == 3, F.col("pos"))).over(own),
            "reset": F.max(F.when(F.col("kind") != 1, F.col("pos"))).over(own),
        }
    )
    begun = F.when(F.col("began") < F.coalesce(F.col("reset"), F.lit(0)), F.col("reset")).otherwise(F.col("began"))
    # A reset before the message began does nothing; a later one drops what came before it.
    piece = F.when(F.col("pos") >= begun, F.struct("pos", F.coalesce("text", F.lit("")).alias("text"), "kind"))
    m = e.groupBy("conv_id", "message", "version").agg(
        F.min("began").alias("began"), F.max("redone").alias("redone"),
        F.min(F.when(F.col("pos") == F.col("began"), F.struct("role")))["role"].alias("role"),
        F.array_sort(F.collect_list(piece)).alias("pieces"),
    ).where("began IS NOT NULL")
    texts = F.transform("pieces", lambda p: F.when(p["kind"] == 3, F.lit("")).otherwise(p["text"]))
    m = m.select("conv_id", F.col("began").alias("at"), "redone", F.coalesce("role", F.lit("")).alias("role"), F.array_join(texts, "").alias("text"))
    earlier = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("taken", F.max(F.when(F.col("redone") > F.col("at"), F.col("redone"))).over(earlier))
    return m.where("taken IS NULL OR taken < at").select("conv_id", "at", "role", "text")


def render(messages: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments: the parts of ``formatted`` in order, with loss true for what is learned."""
    part = lambda text, loss: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    learned = F.array(part(F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP)), False), part(escaped(F.col("text")), True), part(F.lit(END), False))
    other = F.array(part(F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP), escaped(F.col("text")), F.lit(END)), False))
    turns = messages.withColumn("parts", F.when(F.col("role") == learned_role, learned).otherwise(other))
    folded = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "parts"))).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: t["parts"]))
    folded = folded.select("conv_id", segments.alias("segments"))
    return folded.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """The turns (role, text) that a rendered conversation spells, unescaped."""
    marked = F.split(formatted, rf"\Q{END}\E")
    turns = F.slice(marked, 1, F.size(marked) - 1)

    def turn(t: Column) -> Column:
        both = F.split(F.substr(t, F.lit(len(START) + 1)), rf"\Q{SEP}\E")
        return F.struct(unescaped(both[0]).alias("role"), unescaped(both[1]).alias("text"))

    return F.transform(turns, turn)


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and digests read back from rendered conversations and their loss masks."""
    rows = rendered.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), "segments")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    rows = rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), turns.alias("turns"), loss.alias("loss"), "formatted")
    return rows.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def as_log(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of finished turns as the log of their appends."""
    return rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("seq"), F.lit("append").alias("kind"), F.col(turn).alias("message"), F.col(role).alias("role"), F.col(text).alias("text"))
