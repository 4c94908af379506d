"""Chat records of many layouts turned into canonical turns, and turns into templated text with a loss mask. DataFrame functions only.

A record is a JSON text. Its nested field paths (names and nesting, without the types of leaves) are hashed; the hash selects a
declarative mapping, which says where the turns lie and what the roles are called. The template marks turns with control strings
and rewrites control strings within texts, so that the marks are unmistakable and the texts can be had back exactly.

A long conversation is put into several records of bounded numbers of turns, so that a hot one is parsed and formatted by many tasks;
only its templated text is joined at the end, since its digest is one.

Defined cases: a null text or role is empty; a record that is not JSON, that is beyond the 128 MB a parsed value may have, or whose
fingerprint no mapping has (one more field makes another fingerprint), keeps its row with null turns and ``layout`` null (the query
stops with an error rather than give null digests); a record with an empty list has no turns; rows of a conversation that share a turn
number stand in the order of role and text, rows without a turn number first; repeated rows are turns of their own; an empty table gives
no rows; columns not named are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: its shape, and either the list of turns (path, role field, text field, what roles are called) or one (role, path) per turn."""

    name: str
    shape: str
    turns: tuple[tuple[str, str], ...] = ()
    path: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprints(self) -> list[str]:
        """That of the shape, and for a list of turns that of the shape with an empty list."""
        shapes = [self.shape] + ([f"OBJECT<{self.path.removeprefix('$.')}:ARRAY<VOID>>"] if self.path else [])
        return [hashlib.sha256(x.encode()).hexdigest() for x in shapes]


CALLED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
MAPPINGS = (
    Mapping("messages", "OBJECT<messages:ARRAY<OBJECT<content,role>>>", path="$.messages", role="role", text="content", roles=CALLED),
    Mapping("conversations", "OBJECT<conversations:ARRAY<OBJECT<from,value>>>", path="$.conversations", role="from", text="value", roles=CALLED),
    Mapping("rows", "OBJECT<rows:ARRAY<OBJECT<role,text,turn>>>", path="$.rows", role="role", text="text"),
    Mapping("prompt", "OBJECT<completion,prompt>", (("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("prompt_response", "OBJECT<prompt,response>", (("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("system_prompt", "OBJECT<completion,prompt,system>", (("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("instruction", "OBJECT<instruction,output>", (("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping("instruction_input", "OBJECT<input,instruction,output>", (("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Mapping("question", "OBJECT<answer,question>", (("user", "$.question"), ("assistant", "$.answer"))),
    Mapping("nested", "OBJECT<data:OBJECT<completion,prompt>>", (("user", "$.data.prompt"), ("assistant", "$.data.completion"))),
)

MARK, END = "<|turn|>", "<|end|>"


def shape_of(value: Column) -> Column:
    """Names and nesting of a parsed record's fields, in name order: the listing that is hashed. Types of leaves are left out."""
    listing = F.regexp_replace(F.schema_of_variant(value), ": (?!OBJECT<|ARRAY<)[A-Z]+(\\([0-9, ]+\\))?", "")
    return F.regexp_replace(F.regexp_replace(listing, ": (?=OBJECT<|ARRAY<)", ":"), ", ", ",")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _reader(m: Mapping):
    """Turn of one element of the mapping's list."""
    called = F.create_map(*(F.lit(x) for pair in m.roles for x in pair)) if m.roles else None
    return lambda x: _turn(x[m.role] if called is None else F.coalesce(called[x[m.role]], x[m.role]), x[m.text])


def canonical_turns(records: DataFrame, record_column: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """The records with ``fingerprint``, ``layout`` (the mapping's name) and ``turns`` in place of the record."""
    keep = [c for c in records.columns if c not in (record_column, "fingerprint", "layout", "turns")]
    parsed = records.select(*keep, F.try_parse_json(F.col(record_column)).alias("__v"))
    printed = parsed.withColumn("fingerprint", F.sha2(shape_of(F.col("__v")).cast("binary"), 256))
    turns, layout = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for m in mappings:
        here = F.col("fingerprint").isin(m.fingerprints)
        if m.path:
            listed = F.try_variant_get(F.col("__v"), m.path, f"array<struct<`{m.role}`:string,`{m.text}`:string>>")
            got = F.transform(listed, _reader(m))
        else:
            got = F.array(*(_turn(F.lit(r), F.try_variant_get(F.col("__v"), p, "string")) for r, p in m.turns))
        turns, layout = F.when(here, got).otherwise(turns), F.when(here, F.lit(m.name)).otherwise(layout)
    return printed.select(*keep, "fingerprint", layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    """Backslashes and the first characters of control strings become a backslash and a letter."""
    text = F.regexp_replace(text, r"\\", r"\\e")
    text = F.regexp_replace(text, r"<(?=\||/?s>|</?SYS>>)", r"\\l")
    return F.regexp_replace(text, r"\[(?=/?INST\])", r"\\b")


def unescape(text: Column) -> Column:
    """A backslash in escaped text always has its letter, so that the order below gives the text back."""
    text = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    return F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\e"), F.lit("\\"))


def format_turns(canonical: DataFrame, turns_column: str = "turns") -> DataFrame:
    """Adds ``segments``: stretches of the templated text with their loss flag; joined, they are the text. Loss falls on assistants' texts."""
    marked = F.transform(
        turns_column,
        lambda t: F.array(
            F.struct(F.concat(F.lit(MARK), F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        ),
    )
    return canonical.withColumn("segments", F.flatten(marked))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column) -> Column:
    """Turns read back from templated text."""
    parts = F.split(text, r"<\|end\|>\n", -1)
    whole = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))  # nothing follows the last end mark

    def turn(p: Column) -> Column:
        at = F.instr(p, "\n")
        return F.struct(unescape(p.substr(F.lit(len(MARK) + 1), at - len(MARK) - 1)).alias("role"), unescape(p.substr(at + 1, F.length(p))).alias("text"))

    return F.transform(whole, turn)


def loss_text(segments: Column) -> Column:
    return unescape_all(F.filter(segments, lambda s: s["loss"]))


def unescape_all(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: unescape(s["text"])), "")


def conversation_records(rows: DataFrame, turns_a_record: int | None = None) -> DataFrame:
    """Rows of turns (conv_id, turn, role, text) put together to records: conv_id, part, record. All turns in one, or about ``turns_a_record`` in each part.

    The records have the layouts in which such data come: exchanges with plain roles take one that a hash of the conversation's id
    chooses, all others the list of rows.
    """
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    part = F.lit(0) if turns_a_record is None else F.coalesce(F.floor(F.col("turn").cast("bigint") / turns_a_record), F.lit(-(2**63)))
    got = rows.groupBy("conv_id", part.cast("bigint").alias("part")).agg(F.array_sort(F.collect_list(turn)).alias("rows"))
    # array_sort puts a turn without number last; it goes first
    first = F.concat(F.filter("rows", lambda x: x["turn"].isNull()), F.filter("rows", lambda x: x["turn"].isNotNull()))
    got = got.select("conv_id", "part", first.alias("rows"))
    roles, said = F.array_join(F.transform("rows", lambda x: x["role"]), ","), lambda k: F.get("rows", F.lit(k))["text"]
    plain = F.forall("rows", lambda x: x["role"].isin("system", "user", "assistant"))
    lot = lambda n: F.pmod(F.xxhash64("conv_id"), F.lit(n))
    record = lambda *fields: F.to_json(F.struct(*(said(k).alias(name) for name, k in fields)))
    pair, three = (F.size("rows") == 2) & (roles == "user,assistant"), (F.size("rows") == 3) & (roles == "system,user,assistant")
    listed = lambda name, *fields: F.to_json(F.struct(F.transform("rows", lambda x: F.struct(*(c(x).alias(f) for f, c in fields))).alias(name)))
    role, text = lambda x: x["role"], lambda x: x["text"]
    made = (
        F.when(pair & (lot(6) == 0), record(("prompt", 0), ("response", 1)))
        .when(pair & (lot(6) == 1), record(("instruction", 0), ("output", 1)))
        .when(pair & (lot(6) == 2), record(("question", 0), ("answer", 1)))
        .when(pair & (lot(6) == 3), F.to_json(F.struct(F.struct(said(0).alias("prompt"), said(1).alias("completion")).alias("data"))))
        .when(pair, record(("prompt", 0), ("completion", 1)))
        .when(three & (lot(2) == 0), record(("instruction", 0), ("input", 1), ("output", 2)))
        .when(three, record(("system", 0), ("prompt", 1), ("completion", 2)))
        .when(plain & (lot(3) == 0), listed("messages", ("role", role), ("content", text)))
        .when(plain & (lot(3) == 1), listed("conversations", ("from", role), ("value", text)))
        .otherwise(listed("rows", ("turn", lambda x: F.coalesce(x["turn"], F.lit(-1))), ("role", role), ("text", text)))
    )
    return got.select("conv_id", "part", made.alias("record"))


def joined(parts: DataFrame) -> DataFrame:
    """conv_id and whole: the templated texts of a conversation's parts (conv_id, part, segments), joined in their order."""
    texts = parts.select("conv_id", "part", formatted(F.col("segments")).alias("text"))
    return texts.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "").alias("whole"))


CHECK_TEXT = "</s>[INST] ok [/INST]"


TURNS_A_RECORD = 64


def op9_chat_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, read back from the templated text, of every conversation and of one whose texts look like control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"SELECT -1L conv_id, stack(2, 0L, 'user', '{CHECK_TEXT}', 1L, 'assistant', '{CHECK_TEXT}') AS (turn, role, text)")
    canonical = canonical_turns(conversation_records(rows.unionByName(extra), TURNS_A_RECORD))
    whole = F.coalesce("turns", F.raise_error(F.lit("a record has no layout, or is beyond the size of a parsed value")).cast(TURNS))
    out = joined(format_turns(canonical.withColumn("turns", whole))).select("conv_id", "whole", read_turns(F.col("whole")).alias("back"))
    # texts under the loss mask as they stand in the templated text, between the marks of assistants' turns
    loss = F.array_join(F.transform(F.filter("back", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    digest = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", "whole", "back", loss.alias("loss")).select(
        "conv_id", F.size("back").cast("bigint").alias("n_turns"), F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.length("whole").cast("bigint").alias("formatted_chars"),
    )


OP9_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CHECK_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CHECK_TEXT}'
), marked AS (
  SELECT *, regexp_replace(regexp_replace(replace(text, '\\', '\\e'), '<(\\||/?s>|</?SYS>>)', '\\\\l\\1', 'g'), '\\[(/?INST\\])', '\\\\b\\1', 'g') AS shown,
    replace(regexp_replace(regexp_replace(replace(role, '\\', '\\e'), '<(\\||/?s>|</?SYS>>)', '\\\\l\\1', 'g'), '\\[(/?INST\\])', '\\\\b\\1', 'g'), chr(10), '\\n') AS shown_role FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(shown) + length(shown_role) + {len(MARK) + len(END) + 2})::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
