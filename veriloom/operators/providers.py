"""Language models behind one interface. Calls run inside tasks, errors become a column, and every answer is written before use,
since a repeated task would repeat the calls."""

from __future__ import annotations

import json
import os
import subprocess
import tempfile
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veriloom.sources.storage import cut

RESPONSE = "struct<text:string,model:string,prompt_tokens:int,completion_tokens:int,error:string>"
#: The HTTP codes after which a request is repeated without its schema.
NO_SCHEMA = (400, 404, 422)


@dataclass
class Response:
    text: str
    model: str = ""
    prompt_tokens: int = 0
    completion_tokens: int = 0


class Provider(Protocol):
    def generate(self, system: str, prompt: str, *, schema: dict | None = None) -> Response: ...


@dataclass
class Rule:
    """An offline provider: the answer is a function of the prompt."""

    answer: Callable[[str], str]
    model: str = "offline"

    def generate(self, system: str, prompt: str, *, schema: dict | None = None) -> Response:
        text = self.answer(prompt)
        return Response(text, self.model, len(prompt.split()), len(text.split()))


@dataclass
class ChatCompletions:
    """An HTTP endpoint of the usual chat form; the key is read from the named variable where the task runs."""

    url: str
    model: str
    key_variable: str = "LLM_API_KEY"
    timeout: int = 600

    def post(self, body: dict, endpoint: str = "chat/completions") -> dict:
        headers = {"Content-Type": "application/json"}
        if key := os.environ.get(self.key_variable):
            headers["Authorization"] = f"Bearer {key}"
        request = urllib.request.Request(f"{self.url.rstrip('/')}/{endpoint}", json.dumps(body).encode(), headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)

    def ask(self, messages: list[dict], **more) -> dict:
        return self.post({"model": self.model, "messages": messages, **more})

    def generate(self, system: str, prompt: str, *, schema: dict | None = None) -> Response:
        messages = [{"role": "system", "content": system}, {"role": "user", "content": prompt}]
        form = {"response_format": {"type": "json_schema", "json_schema": {"name": "answer", "strict": True, "schema": schema}}} if schema else {}
        try:
            got = self.ask(messages, **form)
        except urllib.error.HTTPError as e:
            if not form or e.code not in NO_SCHEMA:
                raise
            messages[-1]["content"] += f"\n\nThe answer is JSON of this schema:\n{json.dumps(schema)}"
            got = self.ask(messages)
        used = got.get("usage") or {}
        return Response(got["choices"][0]["message"]["content"] or "", got.get("model", self.model), used.get("prompt_tokens", 0), used.get("completion_tokens", 0))


@dataclass
class Command:
    """A program that reads the prompt and writes its answer; a non-zero exit is an error."""

    argv: tuple[str, ...]
    timeout: int = 1800

    def generate(self, system: str, prompt: str, *, schema: dict | None = None) -> Response:
        with tempfile.TemporaryDirectory() as own:
            run = subprocess.run(self.argv, input=f"{system}\n\n{prompt}", cwd=own, text=True, capture_output=True, timeout=self.timeout)
        if run.returncode:
            raise RuntimeError((run.stderr or run.stdout)[-4_000:])
        return Response(run.stdout, self.argv[0])


def _submission(schema: dict, name: str) -> dict:
    return {"name": name, "description": "Hands in the final answer.", "parameters": schema}


#: Told before the last round, in which no tool is offered.
LAST_ROUND = "No further look-ups. Hand in your answer now."


@dataclass
class ToolAgent:
    """At most `rounds` rounds of tool calls, then one last answer: a forced submission where a schema is asked for, else text without tools. A tool's exception is its answer's text."""

    chat: ChatCompletions
    tools: dict[str, Callable[..., str]]
    #: name, description, parameters of each tool.
    descriptions: list[dict]
    rounds: int = 12
    submit: str = "submit_answer"

    def call(self, name: str, given: str) -> str:
        try:
            return self.tools[name](**json.loads(given))[-20_000:]
        except Exception as e:  # the model sees it and may go on
            return f"{type(e).__name__}: {e}"

    def offered(self, schema: dict | None, last: bool) -> list[dict]:
        own = [] if last else list(self.descriptions)
        return own + ([_submission(schema, self.submit)] if schema else [])

    def generate(self, system: str, prompt: str, *, schema: dict | None = None) -> Response:
        messages: list[dict[str, Any]] = [{"role": "system", "content": system}, {"role": "user", "content": prompt}]
        spent = [0, 0]
        for k in range(self.rounds + 1):
            last = k == self.rounds
            if last:
                messages.append({"role": "user", "content": LAST_ROUND})
            offered = [{"type": "function", "function": d} for d in self.offered(schema, last)]
            more = {"tools": offered} if offered else {}
            if last and schema:
                more["tool_choice"] = {"type": "function", "function": {"name": self.submit}}
            got = self.chat.ask(messages, **more)
            used = got.get("usage") or {}
            spent = [spent[0] + used.get("prompt_tokens", 0), spent[1] + used.get("completion_tokens", 0)]
            said = got["choices"][0]["message"]
            messages.append(said)
            if not said.get("tool_calls"):
                return Response(said.get("content") or "", self.chat.model, *spent)
            for call in said["tool_calls"]:
                name, given = call["function"]["name"], call["function"]["arguments"]
                if name == self.submit:
                    return Response(given, self.chat.model, *spent)
                messages.append({"role": "tool", "tool_call_id": call["id"], "content": self.call(name, given)})
        raise RuntimeError("no submission")


@dataclass
class ResponsesAgent(ToolAgent):
    """The same over an endpoint that keeps no state: every request carries all items so far."""

    def generate(self, system: str, prompt: str, *, schema: dict | None = None) -> Response:
        items: list[dict[str, Any]] = [{"role": "user", "content": prompt}]
        spent = [0, 0]
        for k in range(self.rounds + 1):
            last = k == self.rounds
            if last:
                items.append({"role": "user", "content": LAST_ROUND})
            offered = [{"type": "function", **d} for d in self.offered(schema, last)]
            body = {"model": self.chat.model, "instructions": system, "input": items, "store": False}
            if offered:
                body |= {"tools": offered, "tool_choice": "required" if last else "auto"}
            got = self.chat.post(body, "responses")
            if got.get("error"):
                raise RuntimeError(str(got["error"]))
            used = got.get("usage") or {}
            spent = [spent[0] + used.get("input_tokens", 0), spent[1] + used.get("output_tokens", 0)]
            calls = [x for x in got.get("output", []) if x.get("type") == "function_call"]
            if not calls:
                parts = [part.get("text", "") for x in got.get("output", []) if x.get("type") == "message" for part in x.get("content", [])]
                return Response("\n".join(parts), self.chat.model, *spent)
            for call in calls:
                if call["name"] == self.submit:
                    return Response(call["arguments"], self.chat.model, *spent)
                items += [call, {"type": "function_call_output", "call_id": call["call_id"], "output": self.call(call["name"], call["arguments"])}]
        raise RuntimeError("no submission")


def source_tools(root: str, check: Callable[[str], str] | None = None, lines: int = 400, hits: int = 40) -> tuple[dict[str, Callable[..., str]], list[dict]]:
    """(tools, descriptions) over a tree of source files where the task runs: search, read and, if a checker is given, check. Paths outside the tree raise."""
    import re
    from pathlib import Path

    base = Path(root).resolve()

    def inside(path: str) -> Path:
        found = (base / path).resolve()
        if not found.is_relative_to(base):
            raise PermissionError(f"outside the source tree: {path}")
        return found

    def search(pattern: str) -> str:
        wanted, out = re.compile(pattern), []
        for file in sorted(base.rglob("*.lean")):
            found = [f"{file.relative_to(base)}:{k}:{x}" for k, x in enumerate(file.read_text(encoding="utf-8").split("\n"), 1) if wanted.search(x)]
            out += found[:hits]
        return "\n".join(out)

    def read(path: str, start: int = 1, end: int = lines) -> str:
        rows = inside(path).read_text(encoding="utf-8").split("\n")
        first, last = max(1, start), min(end, start + lines)
        return "\n".join(f"{k}: {x}" for k, x in enumerate(rows, 1) if first <= k <= last)

    text, number = {"type": "string"}, {"type": "integer"}
    tools: dict[str, Callable[..., str]] = {"search": search, "read": read}
    descriptions = [
        {"name": "search", "description": "Lines of the source tree that match a regular expression.", "parameters": {"type": "object", "properties": {"pattern": text}, "required": ["pattern"]}},
        {"name": "read", "description": "Numbered lines of a file.", "parameters": {"type": "object", "properties": {"path": text, "start": number, "end": number}, "required": ["path"]}},
    ]
    if check is not None:
        tools["check"] = check
        descriptions.append({"name": "check", "description": "The checker's output for a piece of source.", "parameters": {"type": "object", "properties": {"source": text}, "required": ["source"]}})
    return tools, descriptions


def generate(rows: DataFrame, provider: Provider, system: str, prompt: str, out: str = "response", schema: dict | None = None, tasks: int | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """rows and the provider's answers to the column `prompt`, one call a row; a failed call has an error and no text. Written at once, but for the columns `without`."""
    full = StructType.fromDDL(f"{out} {RESPONSE}")
    dealt = rows.repartition(tasks) if tasks else rows

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(full[0].dataType)
        for batch in batches:
            made = []
            for p in batch.column(prompt).to_pylist():
                try:
                    r = provider.generate(system, p or "", schema=schema)
                    made.append({"text": r.text, "model": r.model, "prompt_tokens": r.prompt_tokens, "completion_tokens": r.completion_tokens, "error": None})
                except Exception as e:  # a row's failure doesn't end the batch
                    made.append({"text": None, "model": None, "prompt_tokens": 0, "completion_tokens": 0, "error": f"{type(e).__name__}: {e}"})
            yield batch.append_column(out, pa.array(made, kind))

    return cut(dealt.mapInArrow(run, StructType([*rows.schema.fields, *full.fields])).drop(*without))


def scripted(rows: DataFrame, answers: DataFrame, key: list[str], out: str = "response") -> DataFrame:
    """rows with recorded answers (key columns, text): the offline provider whose answers don't depend on the order of calls."""
    made = F.struct(F.col("text"), F.lit("scripted").alias("model"), F.lit(0).alias("prompt_tokens"), F.lit(0).alias("completion_tokens"), F.when(F.col("text").isNull(), "no answer").alias("error"))
    return rows.join(answers.select(*key, "text"), key, "left").withColumn(out, made).drop("text")
