"""What models are asked in the graphs: system texts and prompt columns in this library's own words, and Ask functions made of a provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import text as T
from veriloom.operators import providers
from veriloom.operators.answers import AnswerLog

PLANNER = (
    "You plan a formal proof and write no code. Name the steps in order, the known results that each step rests on, the statements worth proving on the way, and where elaboration, missing instances "
    "or changed names are likely to get in the way. Everything that could be looked up is in the message; there is nothing to run."
)
EXECUTOR = (
    "You carry out a proof plan. Answer with JSON that holds every file you change, whole. Keep each declaration's statement as it is. Leave no gap open, assume nothing as given and turn no check off. "
    "Let the checker's messages decide what to change, and change no more than that. The checker runs after you, not with you."
)
PROVER = "You prove one statement. Answer with JSON: the proof's body, and notes if you have any."
#: The answers' shapes.
FILES_SCHEMA = {
    "type": "object", "required": ["files"], "additionalProperties": False,
    "properties": {"files": {"type": "array", "items": {"type": "object", "required": ["path", "content"], "additionalProperties": False, "properties": {"path": {"type": "string"}, "content": {"type": "string"}}}}},
}
PROOF_SCHEMA = {"type": "object", "required": ["proof", "notes"], "additionalProperties": False, "properties": {"proof": {"type": "string"}, "notes": {"type": "string"}}}


def _section(title: str, body: Column) -> Column:
    """A titled part; none where the body is null or empty."""
    return F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit(f"## {title}\n"), body))


def _joined(*sections: Column) -> Column:
    return F.concat_ws("\n\n", *sections)


def plan_prompt() -> Column:
    """Of rows with focus (path, line), goal, retrieval, prior_plan, source, as repair gives them."""
    where = F.concat(F.col("focus.path"), F.lit(", line "), F.col("focus.line").cast("string"))
    return _joined(_section("Gap", where), _section("Goal and messages", F.col("goal")), _section("Lines of the library", F.col("retrieval")), _section("Plan so far", F.col("prior_plan")), _section("File", F.col("source")))


def patch_prompt() -> Column:
    """Of rows with files (path, content), plan, feedback (its last 10,000 characters), retrieval."""
    return _joined(_section("Plan", F.col("plan")), _section("Messages", T.tail(F.col("feedback"), 10_000)), _section("Lines of the library", F.col("retrieval")), _section("Files", F.to_json("files")))


def proof_prompt(informal: str | None = None) -> Column:
    """Of rows with path, content, attempt, feedback (its last 6,000 characters), previous and, if named, a column with the informal statement."""
    rules = F.lit("Give only what stands below `:= by`, without that `by`. No gaps, no axioms, nothing unsafe; the statement stays. You may read the library; you can't run the checker, it runs once after you.")
    told = _section("Informal statement", F.col(informal)) if informal else F.lit(None).cast("string")
    return _joined(
        _section("File", F.concat("path", F.lit("\n```lean\n"), "content", F.lit("\n```"))), told, _section("Rules", rules), _section("Attempt", F.col("attempt").cast("string")),
        _section("What the checker said last", T.tail(F.col("feedback"), 6_000)), _section("The proof that it was about", F.col("previous")),
    )


def asker(provider: providers.Provider, system: str, prompt: Column, schema: dict | None = None, log: AnswerLog | None = None, tasks: int | None = None):
    """An Ask for repair, repair_stream or baseline: project, text, tokens, trace (the whole exchange) and error; a failed call's text is empty. With a log no question is asked twice."""

    def ask(rows: DataFrame) -> DataFrame:
        asked = rows.select("project", prompt.alias("prompt"))
        call = log.generate if log is not None else lambda r, *a, **k: providers.generate(r, *a, **k)
        said = call(asked, provider, system, "prompt", schema=schema, tasks=tasks)
        r = F.col("response")
        trace = F.to_json(F.struct(F.lit(system).alias("system"), "prompt", r["text"].alias("text"), r["model"].alias("model"), r["error"].alias("error")))
        return said.select("project", F.coalesce(r["text"], F.lit("")).alias("text"), (r["prompt_tokens"] + r["completion_tokens"]).alias("tokens"), trace.alias("trace"), r["error"].alias("error"))

    return ask


def planner(provider: providers.Provider, log: AnswerLog | None = None):
    return asker(provider, PLANNER, plan_prompt(), None, log)


def executor(provider: providers.Provider, log: AnswerLog | None = None):
    return asker(provider, EXECUTOR, patch_prompt(), FILES_SCHEMA, log)


def prover(provider: providers.Provider, log: AnswerLog | None = None, informal: str | None = None):
    return asker(provider, PROVER, proof_prompt(informal), PROOF_SCHEMA, log)
