"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records of different layouts sit in one table, each with the nested fields of
its own layout set and the others null (what `unionByName` with missing
columns gives).  The fingerprint of a record is the hash of the sorted nested
field paths that it has; it selects a declarative mapping that says which
paths hold the turns.  Canonical turns are then written with a template that
marks every turn, and read back from it.

The template is `<|im_start|>role\\ntext<|im_end|>\\n`.  Inside a role or text
`&`, `<`, `[INST]` and `[/INST]` are escaped, so no control string of this or
another common template is left there; unescaping gives the exact text back.

Cases: null text or role is empty; turns that tie on their number are ordered
by role and text, so repeated rows stay, in a defined order; rows without a
conversation id form one conversation without an id; a record whose
fingerprint no mapping names has a null layout and no turns; an empty table
gives no rows; fields that no layout names are not part of a fingerprint.
A conversation is one value, so its turns meet in one task; nothing else does.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

#: Escapes in the order they are applied; unescaping goes the other way.  A
#: role is one line, so its line ends are escaped too.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[INST]", "&#91;INST]"), ("[/INST]", "&#91;/INST]"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))
UNESCAPES = (("&#10;", "\n"), ("&#91;", "["), ("&lt;", "<"), ("&amp;", "&"))


@dataclass(frozen=True)
class Layout:
    """A layout: where its turns are.

    ``turns``: (role, path) in order.  ``messages``: the path of an array and
    the names of its role and text fields.  ``optional``: paths that a record
    may lack.  ``roles``: other names of the canonical roles."""
    name: str
    turns: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> tuple[str, ...]:
        if self.messages:
            at, role, text = self.messages
            return (f"{at}[].{role}", f"{at}[].{text}")
        return tuple(path for _, path in self.turns)

    def path_sets(self) -> list[str]:
        """The path lists that select this layout, each as fingerprinted."""
        may = [p for p in self.paths if p in self.optional]
        return ["\n".join(sorted(set(self.paths) - set(gone))) for k in range(len(may) + 1) for gone in combinations(may, k)]


LAYOUTS = (
    Layout("messages", messages=("messages", "role", "content")),
    Layout("shared", messages=("conversations", "from", "value"), roles=(("human", "user"), ("gpt", "assistant"))),
    Layout("prompt", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("completion", turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", turns=(("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Layout("nested", turns=(("user", "data.question"), ("assistant", "data.answer"))),
)


def _replace(col: Column, pairs) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, col)


def escape(col: Column) -> Column:
    return _replace(col, ESCAPES)


def unescape(col: Column) -> Column:
    return _replace(col, UNESCAPES)


def _present(schema: T.StructType, known: set[str]) -> list[Column]:
    """For each leaf of the schema that a layout names: its path, where the
    record has it."""
    out = []

    def walk(fields, at: str):
        for f in fields:
            path = f"{at}{f.name}"
            kind = f.dataType
            if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
                out.extend(F.when(F.col(path).isNotNull(), F.lit(f"{path}[].{e.name}"))
                           for e in kind.elementType if f"{path}[].{e.name}" in known)
            elif isinstance(kind, T.StructType):
                walk(kind.fields, f"{path}.")
            elif path in known:
                out.append(F.when(F.col(path).isNotNull(), F.lit(path)))

    walk(schema.fields, "")
    return out


def fingerprint(records: DataFrame, layouts=LAYOUTS) -> Column:
    """Hash of the sorted nested field paths that a record has."""
    present = _present(records.schema, {p for layout in layouts for p in layout.paths})
    if not present:
        return F.xxhash64(F.lit(""))
    return F.xxhash64(F.array_join(F.array_sort(F.array_compact(F.array(*present))), "\n"))


def canonical_turns(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns``, an array of
    (role, text)."""
    names = set(_leaves(records.schema))
    records = records.withColumn("fingerprint", fingerprint(records, layouts))
    name, turns = F.lit(None).cast("string"), F.array().cast("array<struct<role:string,text:string>>")
    empty = F.lit("")
    for layout in layouts:
        if not set(layout.paths) - set(layout.optional) <= names:
            continue        # no record of this table can have it
        mine = F.col("fingerprint").isin([F.xxhash64(F.lit(p)) for p in layout.path_sets()])
        if layout.messages:
            at, role, text = layout.messages

            def one(m):
                said = reduce(lambda c, p: F.when(m[role] == p[0], p[1]).otherwise(c), layout.roles, m[role])
                return F.struct(F.coalesce(said, empty).alias("role"), F.coalesce(m[text], empty).alias("text"))
            found = F.transform(at, one)
        else:
            found = F.array_compact(F.array(*[
                F.when(F.col(path).isNotNull() if path in layout.optional else F.lit(True),
                       F.struct(F.lit(role).alias("role"), F.coalesce(F.col(path), empty).alias("text")))
                for role, path in layout.turns if path in names]))
        name, turns = F.when(mine, layout.name).otherwise(name), F.when(mine, found).otherwise(turns)
    return records.withColumn("layout", name).withColumn("turns", turns)


def _leaves(schema: T.StructType, at: str = "") -> list[str]:
    out = []
    for f in schema:
        kind, path = f.dataType, f"{at}{f.name}"
        if isinstance(kind, T.StructType):
            out += _leaves(kind, f"{path}.")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out += [f"{path}[].{e.name}" for e in kind.elementType]
        else:
            out.append(path)
    return out


def formatted(df: DataFrame) -> DataFrame:
    """``turns`` written with the template: ``formatted``, and ``loss_mask``,
    the places (start, length; code points) of the assistant's texts in it."""
    marks = len(OPEN) + 1 + len(CLOSE) + 1
    parts = F.transform("turns", lambda t: F.struct(_replace(t["role"], ROLE_ESCAPES).alias("role"), escape(t["text"]).alias("text"),
                                                    (t["role"] == "assistant").alias("loss")))
    df = df.withColumn("__parts", parts)
    text = F.array_join(F.transform("__parts", lambda p: F.concat(F.lit(OPEN), p["role"], F.lit("\n"), p["text"], F.lit(CLOSE + "\n"))), "")
    sizes = F.transform("__parts", lambda p: (F.length(p["role"]) + F.length(p["text"]) + marks).cast("long"))
    spans = "array<struct<start:bigint,length:bigint>>"
    mask = F.aggregate(
        F.arrays_zip("__parts", sizes.alias("size")),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(spans).alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["size"]).alias("at"),
            F.when(x["__parts"]["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + len(OPEN) + 1 + F.length(x["__parts"]["role"])).cast("long").alias("start"),
                F.length(x["__parts"]["text"]).cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return df.withColumn("formatted", text).withColumn("loss_mask", mask).drop("__parts")


def read_back(df: DataFrame) -> DataFrame:
    """From ``formatted`` and ``loss_mask`` alone: ``read_turns`` and
    ``loss_text``, both unescaped."""
    parts = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda p: p.startswith(OPEN))

    def turn(p):
        body = F.substring(p, len(OPEN) + 1, 2**31 - 1)
        cut = F.instr(body, F.lit("\n"))
        return F.struct(unescape(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substring(body, cut + 1, F.lit(2**31 - 1))).alias("text"))

    loss = F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return df.withColumn("read_turns", F.transform(parts, turn)).withColumn("loss_text", F.array_join(loss, ""))


def records_of(conversations: DataFrame) -> DataFrame:
    """Rows by turn as one record per conversation: a user's question with its
    answer in the prompt layout, anything else as messages."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    held = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("rows"))
    roles = F.transform("rows", lambda r: r["role"])
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    return held.select(
        "conv_id",
        F.when(pair, F.col("rows")[0]["content"]).alias("prompt"),
        F.when(pair, F.get("rows", F.lit(1))["content"]).alias("response"),
        F.when(~pair, F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content")))).alias("messages"))


def digest(read: DataFrame) -> DataFrame:
    whole = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
