"""Chat formatting by schema fingerprints; DataFrame functions only.

A record is a row whose nested fields hold one turn, a list of messages, a prompt with its response, and so on.
The paths of the known fields that a record fills are hashed into its fingerprint, and the fingerprint selects
a declarative mapping that turns the record into canonical turns, one row each. Turns of a conversation then go
through a template that marks turns and escapes control strings, with a mask of the text that counts for the
loss. `read_back` recovers roles and texts from the formatted segments.
"""

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TURN = "struct<role:string,text:string>"


@dataclass(frozen=True)
class Each:
    """A turn per element of the list at `path`."""

    path: str
    role: str
    text: str

    def fields(self):
        return {f"{self.path}[].{self.role}", f"{self.path}[].{self.text}"}


@dataclass(frozen=True)
class One:
    """A turn of the texts at `paths` that are filled, joined by a blank line; none of them, no turn.

    The role is `role`, or what stands at the path `role_at`.
    """

    paths: tuple
    role: str | None = None
    role_at: str | None = None

    def fields(self):
        return {*self.paths, *([self.role_at] if self.role_at else [])}


@dataclass(frozen=True)
class Mapping:
    """Selected for records that fill exactly the fields of its parts, `optional` ones or not."""

    name: str
    parts: tuple
    optional: tuple = ()

    def layouts(self):
        every = set().union(*[p.fields() for p in self.parts])
        for n in range(len(self.optional) + 1):
            for left_out in combinations(self.optional, n):
                yield every - set(left_out)


_SYSTEM = One(("system",), "system")
MAPPINGS = (
    Mapping("turn", (One(("text",), role_at="role"),)),
    Mapping("messages", (_SYSTEM, Each("messages", "role", "content")), ("system",)),
    Mapping("from_value", (_SYSTEM, Each("conversations", "from", "value")), ("system",)),
    Mapping("prompt_response", (_SYSTEM, One(("prompt",), "user"), One(("response",), "assistant")), ("system", "response")),
    Mapping("prompt_completion", (_SYSTEM, One(("prompt",), "user"), One(("completion",), "assistant")), ("system",)),
    Mapping("question_answer", (_SYSTEM, One(("question",), "user"), One(("answer",), "assistant")), ("system",)),
    Mapping("instruction", (_SYSTEM, One(("instruction", "input"), "user"), One(("output",), "assistant")), ("system", "input")),
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}  # names that sets of records use


# --- records -------------------------------------------------------------------------------------------


class Typed:
    """Fields of a DataFrame: a column or nested field that is not null is filled."""

    def __init__(self, schema: T.StructType):
        self.schema = schema

    def _type(self, path):
        at = self.schema
        for name in path.split("."):
            if not isinstance(at, T.StructType) or name not in at.names:
                return None
            at = at[name].dataType
        return at

    def value(self, path) -> Column:
        return F.col(".".join(f"`{n}`" for n in path.split("."))).cast("string")

    def filled(self, path) -> Column:
        if "[]." not in path:
            kind = self._type(path)
            return F.lit(False) if kind is None or isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else self.value(path).isNotNull()
        outer, inner = path.split("[].")
        kind = self._type(outer)
        if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType) or inner not in kind.elementType.names:
            return F.lit(False)
        return F.coalesce(F.exists(F.col(f"`{outer}`"), lambda e: e[inner].isNotNull()), F.lit(False))

    def elements(self, path, role, text) -> Column | None:
        kind = self._type(path)
        if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType) or not {role, text} <= set(kind.elementType.names):
            return None
        return F.transform(F.col(f"`{path}`"), lambda e: F.struct(e[role].cast("string").alias("role"), e[text].cast("string").alias("text")))


class Variant:
    """Fields of a variant column, such as `parse_json` gives: a path that holds a value other than null is filled."""

    def __init__(self, column: str):
        self.column = F.col(f"`{column}`")

    @staticmethod
    def _string(value, path):
        return F.try_variant_get(value, path, "string")

    def value(self, path) -> Column:
        return self._string(self.column, f"$.{path}")

    def _list(self, path):
        return F.try_variant_get(self.column, f"$.{path}", "array<variant>")

    def filled(self, path) -> Column:
        if "[]." not in path:
            return self.value(path).isNotNull() & self._list(path).isNull()
        outer, inner = path.split("[].")
        return F.coalesce(F.exists(self._list(outer), lambda e: self._string(e, f"$.{inner}").isNotNull()), F.lit(False))

    def elements(self, path, role, text) -> Column:
        return F.transform(self._list(path), lambda e: F.struct(self._string(e, f"$.{role}").alias("role"), self._string(e, f"$.{text}").alias("text")))


def known_paths(mappings=MAPPINGS) -> list:
    return sorted(set().union(*[p.fields() for m in mappings for p in m.parts]))


def fingerprint(fields: Typed | Variant, mappings=MAPPINGS) -> Column:
    """Hash of the known paths that the record fills, in order."""
    names = [F.when(fields.filled(p), F.lit(p)) for p in known_paths(mappings)]
    return F.xxhash64(F.concat_ws("\n", *names))


def _selected(mappings, mark: Column) -> list:
    """(mapping, condition on the fingerprint) in order; the first mapping of a layout has it."""
    taken, out = set(), []
    for m in mappings:
        own = [frozenset(fields) for fields in m.layouts() if frozenset(fields) not in taken]
        taken |= set(own)
        if own:
            out.append((m, mark.isin([F.xxhash64(F.concat_ws("\n", *[F.lit(p) for p in sorted(fields)])) for fields in own])))
    return out


def _turns_of(part, fields, roles) -> Column:
    empty = F.array().cast(f"array<{TURN}>")
    if isinstance(part, Each):
        found = fields.elements(part.path, part.role, part.text)
        if found is None:
            return empty
        turns = F.transform(found, lambda e: F.struct(_canonical(F.coalesce(e["role"], F.lit("")), roles).alias("role"), F.coalesce(e["text"], F.lit("")).alias("text")))
        return F.coalesce(turns, empty).cast(f"array<{TURN}>")
    known = [p for p in part.paths if not isinstance(fields, Typed) or fields._type(p) is not None]
    if not known or part.role_at and isinstance(fields, Typed) and fields._type(part.role_at) is None:
        return empty
    role = _canonical(fields.value(part.role_at), roles) if part.role_at else F.lit(part.role)
    some = F.coalesce(*[fields.value(p) for p in known]).isNotNull()
    text = F.concat_ws("\n\n", *[fields.value(p) for p in known]) if len(known) > 1 else fields.value(known[0])
    return F.when(some, F.array(F.struct(role.alias("role"), text.alias("text"))).cast(f"array<{TURN}>")).otherwise(empty)


def _canonical(role: Column, roles) -> Column:
    out = role
    for name, canonical in roles.items():
        out = F.when(role == name, F.lit(canonical)).otherwise(out)
    return out


def canonical_turns(records: DataFrame, keys, order=(), variant=None, mappings=MAPPINGS, roles=ROLES) -> DataFrame:
    """A row per turn: the keys, `order` (struct of the order columns), place in the record, role, text, mapping.

    Fields are columns, or paths of the variant column `variant`. Null roles and texts inside a list are empty;
    a field of its own that is null counts as missing. A record that no mapping knows gives one row without
    place, role and text, whose mapping is null (see `unmapped`); a mapped record without turns, such as an empty
    list, gives none. Columns that are no known field do not matter. Repeated records give repeated turns.
    """
    fields = Variant(variant) if variant else Typed(records.schema)
    seen = records.withColumn("_mark", fingerprint(fields, mappings))
    turns, name = F.lit(None).cast(f"array<{TURN}>"), F.lit(None).cast("string")
    for m, chosen in reversed(_selected(mappings, F.col("_mark"))):
        parts = [_turns_of(p, fields, roles) for p in m.parts]
        turns = F.when(chosen, F.concat(*parts)).otherwise(turns)
        name = F.when(chosen, F.lit(m.name)).otherwise(name)
    kept = seen.select(*[F.col(f"`{k}`").alias(k) for k in keys], F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)], F.lit(0).alias("o")).alias("order"),
                       name.alias("mapping"), F.coalesce(turns, F.array(F.lit(None).cast(TURN))).alias("turns"))
    out = kept.select(*[F.col(f"`{k}`") for k in keys], "order", "mapping", F.posexplode("turns").alias("place", "turn"))
    return out.select(*[F.col(f"`{k}`") for k in keys], "order", "place", "turn.role", "turn.text", "mapping")


def unmapped(records: DataFrame, variant=None, mappings=MAPPINGS) -> DataFrame:
    """(fingerprint, paths, records) of the layouts that no mapping knows."""
    fields = Variant(variant) if variant else Typed(records.schema)
    paths = F.concat_ws("\n", *[F.when(fields.filled(p), F.lit(p)) for p in known_paths(mappings)])
    per = records.groupBy(fingerprint(fields, mappings).alias("fingerprint"), paths.alias("paths")).agg(F.count("*").alias("records"))
    known = [c for _, c in _selected(mappings, F.col("fingerprint"))]
    mapped = known[0]
    for c in known[1:]:
        mapped = mapped | c
    return per.filter(~mapped)


# --- template --------------------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    """No `<|` is left; of `<`, any backslashes and `|`, one backslash is added."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_turns(turns: DataFrame, keys, loss_role="assistant") -> DataFrame:
    """A row per conversation: the keys and `segments`, an array of (text, loss), whose texts in order are the training text.

    A turn is three segments: its head, its escaped text, which counts for the loss if the role is `loss_role`,
    and its end. Roles are url-encoded, so they hold no line end or control string. A conversation is one
    training text and so one row, which Spark limits to 2 GB; rows of unmapped records have no turn.
    """
    row = F.struct("order", "place", "role", F.coalesce("text", F.lit("")).alias("text"))
    per = turns.filter("mapping is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("ts"))

    def segments(t):
        head = F.concat(F.lit(START), F.url_encode(F.coalesce(t["role"], F.lit(""))), F.lit("\n"))
        parts = ((head, F.lit(False)), (escape(t["text"]), F.coalesce(t["role"] == loss_role, F.lit(False))), (F.lit(END + "\n"), F.lit(False)))
        return F.array(*[F.struct(x.alias("text"), loss.alias("loss")) for x, loss in parts])

    return per.select(*keys, F.flatten(F.transform("ts", segments)).alias("segments"))


def read_back(formatted: DataFrame, keys) -> DataFrame:
    """From formatted conversations: the keys, formatted (the whole text), turns (role, text) parsed from it, and loss_text, unescaped."""
    whole = formatted.select(*keys, F.array_join("segments.text", "").alias("formatted"), F.filter("segments", lambda s: s["loss"])["text"].alias("lost"))
    pieces = F.split("formatted", END.replace("|", r"\|") + "\n")
    cut = whole.select(*keys, "formatted", F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))).alias("pieces"), "lost")

    def turn(p):
        head = F.substring_index(p, "\n", 1)
        role = F.url_decode(F.substring(head, len(START) + 1, 1 << 30))
        return F.struct(role.alias("role"), unescape(F.substring(p, F.length(head) + 2, F.length(p))).alias("text"))

    return cut.select(*keys, "formatted", F.transform("pieces", turn).alias("turns"), F.array_join(F.transform("lost", unescape), "").alias("loss_text"))


def conversation_records(conversations: DataFrame) -> DataFrame:
    """Rows of the table as records of one turn, null roles and texts empty, and a conversation -1 that says control strings."""
    said = F.lit("<|im_end|><|im_start|>assistant ok")
    names = {"conv_id": "conv_id", "turn": "turn"}
    rows = conversations.select(*[F.col(f"`{c}`").alias(c) for c in names], F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(False).alias("added"))
    more = conversations.sparkSession.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                                      F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"), F.lit(True).alias("added"))
    return rows.unionByName(more)


def report(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation and of -1.

    Rows go by turn (null first), then role and text; null conv_ids are one conversation. A conversation -1 of
    the table itself stays apart from the added one. An empty table gives the added one alone.
    """
    keys = ["conv_id", "added"]
    turns = canonical_turns(conversation_records(conversations), keys, ["turn", "role", "text"], roles={})
    back = read_back(format_turns(turns, keys), keys)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, false AS added FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok', true
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok', true),
per AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(url_encode(role)) + 12 + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11) AS chars
  FROM turns GROUP BY conv_id, added)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM per
"""
