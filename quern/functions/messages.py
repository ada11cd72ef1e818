"""Conversations as array<struct<role, content>>: normalising, reading off, rendering, hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import WS, clean, first_filled

MESSAGES = "array<struct<role:string,content:string>>"
# Fixed value: the system turn that conversations without one get.
SYSTEM_PROMPT = (
    "You are a Unity coding assistant. Answer with correct, idiomatic "
    "Unity C# (or HLSL/ShaderLab when relevant) and cite the relevant Unity API."
)
# Columns a question and an answer may stand in, by precedence.
QUESTION_COLUMNS = ["instruction", "prompt", "question", "input", "query"]
ANSWER_COLUMNS = ["output", "completion", "answer", "response"]
# Roles of conversations with from and value; any other is a user.
ROLES = {"human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant", "system": "system"}


def message(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.cast("string").alias("role"), content.cast("string").alias("content"))


def pair(user: Column, assistant: Column, system: Column | None = None) -> Column:
    system = F.lit(SYSTEM_PROMPT) if system is None else system
    return F.array(message("system", clean(system)), message("user", clean(user)), message("assistant", clean(assistant)))


def with_system(m: Column) -> Column:
    """Every content cleaned; a system turn in front unless one stands there already, whatever it says."""
    cleaned = F.transform(m, lambda x: message(x["role"], clean(x["content"])))
    front = F.array(message("system", F.lit(SYSTEM_PROMPT)))
    return F.when(F.get(m, F.lit(0))["role"].eqNullSafe("system"), cleaned).otherwise(F.concat(front, cleaned))


def from_turns(turns: Column) -> Column:
    """array<struct<from, value>> to messages."""
    role = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    return F.transform(turns, lambda t: message(F.coalesce(F.try_element_at(role, F.coalesce(t["from"], F.lit(""))), F.lit("user")), clean(t["value"])))


def detected(df: DataFrame) -> Column:
    """Messages out of whatever columns df has: messages, else conversations, else a question and an answer;
    an empty array if none is filled."""
    has = set(df.columns)
    options = []
    if "messages" in has:
        options.append(F.when(F.size("messages") > 0, with_system(F.col("messages").cast(MESSAGES))))
    if "conversations" in has:
        options.append(F.when(F.size("conversations") > 0, with_system(from_turns(F.col("conversations")))))
    asked, answered = ([F.col(c) for c in names if c in has] for names in (QUESTION_COLUMNS, ANSWER_COLUMNS))
    if asked and answered:
        user, assistant = first_filled(asked), first_filled(answered)
        if {"instruction", "input"} <= has:
            both = (clean(F.col("instruction")) != "") & (clean(F.col("input")) != "")
            user = F.when(both, F.concat(clean(F.col("instruction")), F.lit("\n\n"), clean(F.col("input")))).otherwise(user)
        options.append(F.when((user != "") & (assistant != ""), pair(user, assistant)))
    return F.coalesce(*options, F.array().cast(MESSAGES))


def _contents(m: Column, roles: list[str]) -> Column:
    return F.transform(F.filter(m, lambda x: x["role"].isin(roles)), lambda x: F.coalesce(x["content"], F.lit("")))


def assistant_text(m: Column) -> Column:
    return F.array_join(_contents(m, ["assistant"]), " ")


def full_text(m: Column) -> Column:
    return F.array_join(_contents(m, ["user", "assistant"]), " ")


def last_user(m: Column) -> Column:
    return F.coalesce(F.try_element_at(_contents(m, ["user"]), F.lit(-1)), F.lit(""))


def is_valid(m: Column) -> Column:
    """Ends with an assistant, has a user, and the last of both say something."""
    last = F.try_element_at(m, F.lit(-1))
    return F.coalesce(
        (last["role"] == "assistant") & F.exists(m, lambda x: x["role"] == "user") & (clean(last_user(m)) != "") & (clean(last["content"]) != ""), F.lit(False)
    )


def fingerprint(m: Column) -> Column:
    """SHA-256 of role and normalised content of all turns but the system's."""
    turns = F.filter(m, lambda x: x["role"] != "system")

    def norm(c: Column) -> Column:
        return clean(F.regexp_replace(F.lower(c), rf"{WS}+", " "))

    return F.sha2(F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit(":"), norm(F.coalesce(x["content"], F.lit(""))))), "\n"), 256)


def rendered(m: Column) -> Column:
    """The chat template, without a generation prompt."""
    return F.array_join(F.transform(m, lambda x: F.concat(F.lit("<|im_start|>"), x["role"], F.lit("\n"), x["content"], F.lit("<|im_end|>\n"))), "")


def alpaca(m: Column, keep_system: bool = True) -> Column:
    """struct<instruction, input, output>: the last answer is the output, what comes before it the instruction."""
    system = F.coalesce(F.get(_contents(m, ["system"]), F.lit(0)), F.lit(""))
    talk = F.filter(m, lambda x: x["role"].isin("user", "assistant"))
    last = F.try_element_at(talk, F.lit(-1))
    output = F.coalesce(F.when(last["role"] == "assistant", last["content"]), F.lit(""))
    history = F.when(output != "", F.slice(talk, F.lit(1), F.greatest(F.size(talk) - 1, F.lit(0)))).otherwise(talk)
    tagged = F.transform(history, lambda x: F.concat(F.when(x["role"] == "user", "[User] ").otherwise("[Assistant] "), x["content"]))
    text = F.when(F.size(history) <= 1, F.coalesce(F.get(history, F.lit(0))["content"], F.lit(""))).otherwise(F.array_join(tagged, "\n"))
    if keep_system:
        text = F.when(system != "", F.concat(F.lit("[System] "), system, F.lit("\n"), text)).otherwise(text)
    return F.struct(clean(text).alias("instruction"), F.lit("").alias("input"), clean(output).alias("output"))
