"""Conversations of any known layout as one marked-up text, with a loss mask.

A record's schema is known by a fingerprint: the hash of those nested field paths
that mean something here, in arrays those of any element.  A table has the layout
of every fingerprint that fits one: of the layouts whose required paths are among
the paths, the one with the most paths present.  Records are joined to it by their
fingerprint, and the layout's declarative mapping gives canonical turns:
conversation, position, role, text.

The template puts ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn.
Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so a
control string in a text stays text, and the original is got back exactly.

Defined results: a null role or text is empty; turns come by ``turn``, nulls
first, then by role and text, so repeated rows and ties have a fixed order; a
null conversation id is a conversation of its own; empty tables give empty ones;
records of no known layout give no turns and carry a null ``layout``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TURN = "array<struct<role:string,text:string>>"

# Paths that mean something in records of the usual layouts; all others are ignored.
PATHS = (
    "messages[].role",
    "messages[].content",
    "conversations[].from",
    "conversations[].value",
    "instruction",
    "input",
    "output",
    "prompt",
    "completion",
    "response",
    "question",
    "answer",
    "system",
    "role",
    "text",
    "turn",
)


def fingerprint(paths: Column) -> Column:
    """The hash that a set of field paths is known by; ``paths`` in the order of ``PATHS``."""
    return F.sha2(F.array_join(paths, ","), 256)


@dataclass(frozen=True)
class Layout:
    """Where the turns of a layout are: an array with two fields, or fields with a fixed role each."""

    name: str
    array: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    # One turn with its own role, which stays as it is, and its own position.
    row: bool = False

    def required(self) -> list[str]:
        own = [f"{self.array[0]}[].{p}" for p in self.array[1:]] if self.array else [p for _, p in self.fields]
        return [p for p in own if p not in self.optional]


LAYOUTS = (
    Layout("messages", ("messages", "role", "content"), optional=("system",)),
    Layout("from_value", ("conversations", "from", "value"), optional=("system",)),
    Layout(
        "instruction",
        fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=("system", "input"),
    ),
    Layout("completion", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Layout("response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("question", fields=(("system", "system"), ("user", "question"), ("assistant", "answer")), optional=("system",)),
    Layout("row", fields=(("role", "role"), ("text", "text")), optional=("turn",), row=True),
)

# Names of the same role.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def canonical_role(role: Column) -> Column:
    named = F.create_map(*[F.lit(v) for pair in ROLES.items() for v in pair])
    return F.coalesce(F.element_at(named, F.lower(role)), role, F.lit(""))


def _elements(record: str, name: str) -> str:
    return f"try_variant_get({record}, '$.{name}', 'array<variant>')"


def _present(record: str, path: str) -> Column:
    """The path if the record has it; inside an array, if any element has it."""
    name, _, field = path.partition("[].")
    if field:
        probe = f"exists({_elements(record, name)}, e -> try_variant_get(e, '$.{field}', 'variant') is not null)"
    else:
        probe = f"try_variant_get({record}, '$.{path}', 'variant') is not null"
    return F.when(F.expr(probe), F.lit(path))


def present_paths(record: str) -> Column:
    """Those of ``PATHS`` that a variant has, a null field too."""
    return F.array_compact(F.array(*[_present(record, p) for p in PATHS]))


def _bits(paths: list[str]) -> Column:
    return F.lit(sum(1 << PATHS.index(p) for p in paths)).cast("bigint")


def _chosen(held: Column) -> Column:
    """The layout with the most paths present of those whose required ones all are; the first of several.

    ``held`` has a bit for each of ``PATHS`` that is present.
    """
    fit = []
    for k, known in enumerate(LAYOUTS):
        must, used = _bits(known.required()), F.bit_count(held.bitwiseAND(_bits([*known.required(), *known.optional])))
        mark = F.struct(used.alias("used"), F.lit(-k).alias("k"), F.lit(known.name).alias("name"))
        fit.append(F.when(held.bitwiseAND(must) == must, mark))
    return F.greatest(*fit)["name"]


def known_fingerprints(spark: SparkSession) -> DataFrame:
    """The layout of every fingerprint that fits one.

    A row for each such set of ``PATHS``, so at most ``2 ** len(PATHS)`` rows whatever the records are.
    """
    sets = spark.range(1 << len(PATHS), numPartitions=1).select("id", _chosen(F.col("id")).alias("layout"))
    held = [F.when(F.col("id").bitwiseAND(F.lit(1 << k)) != 0, F.lit(p)) for k, p in enumerate(PATHS)]
    fitting = sets.where(F.col("layout").isNotNull())
    return fitting.select(fingerprint(F.array_compact(F.array(*held))).alias("fingerprint"), "layout")


def _mapped(record: str, layout: Layout) -> Column:
    if layout.row:
        return F.expr(
            f"array(struct(coalesce(try_variant_get({record}, '$.role', 'string'), '') as role,"
            f" coalesce(try_variant_get({record}, '$.text', 'string'), '') as text))"
        )
    if layout.array:
        name, role, text = layout.array
        each = f"transform({_elements(record, name)}, e -> struct({{}} as role, {{}} as text))"
        got = F.expr(each.format(*[f"try_variant_get(e, '$.{p}', 'string')" for p in (role, text)]))
        listed = F.transform(
            got, lambda t: F.struct(canonical_role(t["role"]).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))
        )
        system = F.expr(f"try_variant_get({record}, '$.system', 'string')")
        head = F.when(
            system.isNotNull(), F.array(F.struct(F.lit("system").alias("role"), system.alias("text")))
        ).otherwise(F.expr(f"cast(array() as {TURN})"))
        return F.concat(head, listed)
    turns = []
    for role, path in layout.fields:
        value = F.expr(f"try_variant_get({record}, '$.{path}', 'string')")
        keep = value.isNotNull() if path not in layout.optional else value.isNotNull() & (value != "")
        turns.append(F.when(keep, F.struct(F.lit(role).alias("role"), value.alias("text"))))
    return F.array_compact(F.array(*turns))


def turns_of_records(records: DataFrame, key: str, record: str, strict: bool = False) -> DataFrame:
    """Canonical turns of JSON ``record`` s of mixed layouts, with the fingerprint that chose the mapping.

    A record that can't be parsed or has no known layout has a null ``layout``, or, if ``strict``, fails
    the job, so that no row is lost unseen.
    """
    parsed = records.select(F.col(key).alias("conv_id"), F.expr(f"try_parse_json({record})").alias("_record"))
    known = known_fingerprints(records.sparkSession)
    # The table is broadcast: its size is fixed by PATHS, and one layout may hold most of the records.
    fitted = parsed.withColumn("fingerprint", fingerprint(present_paths("_record"))).join(
        F.broadcast(known), "fingerprint", "left"
    )
    turns, place = F.expr(f"cast(array() as {TURN})"), F.lit(None).cast("bigint")
    for each in LAYOUTS:
        chosen = F.col("layout") == each.name
        turns = F.when(chosen, _mapped("_record", each)).otherwise(turns)
        if each.row:
            place = F.when(chosen, F.expr("try_variant_get(_record, '$.turn', 'bigint')")).otherwise(place)
    mapped = fitted.select("conv_id", "fingerprint", "layout", place.alias("place"), turns.alias("turns"))
    if strict:
        unknown = F.raise_error(F.concat(F.lit("record without a known layout: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
        mapped = mapped.withColumn("layout", F.coalesce("layout", unknown.cast("string")))
    rows = [k.name for k in LAYOUTS if k.row]
    return mapped.select("*", F.posexplode_outer("turns").alias("position", "t")).select(
        "conv_id",
        "fingerprint",
        "layout",
        F.when(F.col("layout").isin(rows), F.col("place")).otherwise(F.col("position").cast("bigint")).alias("turn"),
        "t.role",
        "t.text",
    )


def escaped(column: Column) -> Column:
    """Text in which no control string is left."""
    return F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(column: Column) -> Column:
    """The inverse of :func:`escaped`."""
    return F.regexp_replace(column, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted``, and in ``loss`` the spans of assistant texts (code points).

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``.  A conversation
    is one text and so one row; turns are laid end to end by a running sum.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).select(
        "*", F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP)).alias("head"), escaped(F.col("text")).alias("body")
    )
    size = F.length("head") + F.length("body") + len(END)
    upto = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    laid = rows.select(
        "conv_id",
        (F.sum(size.cast("bigint")).over(upto) - size).alias("at"),
        F.length("head").alias("skip"),
        F.length("body").alias("width"),
        (F.col("role") == "assistant").alias("learn"),
        F.concat("head", "body", F.lit(END)).alias("piece"),
    )
    listed = laid.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "skip", "width", "learn", "piece"))).alias("t")
    )
    spans = F.transform(
        F.filter("t", lambda t: t["learn"]),
        lambda t: F.struct((t["at"] + t["skip"]).alias("start"), (t["at"] + t["skip"] + t["width"]).alias("end")),
    )
    return listed.select("conv_id", F.array_join(F.col("t.piece"), "").alias("formatted"), spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of role and text."""
    parts = F.filter(F.split(formatted, rf"\Q{END}\E"), lambda p: p != "")

    def turn(p: Column) -> Column:
        sides = F.split(F.substring(p, len(START) + 1, 2147483647), rf"\Q{SEP}\E")
        return F.struct(unescaped(sides[0]).alias("role"), unescaped(sides[1]).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    pieces = F.transform(
        loss,
        lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return F.array_join(pieces, "")


def digests(formatted: DataFrame) -> DataFrame:
    """What formatted conversations hold, read back from them."""
    back = formatted.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    listed = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
