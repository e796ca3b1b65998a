"""Chat formatting: tool calls and their results, linked, ordered, validated, as canonical JSON.

* Calls and results are hash-joined on (conversation, identifier); a repeated identifier belongs
  to its first call (by turn, then arguments), the others are ``duplicate_call``; every result
  of an identifier is linked to that call; a result without a call is ``orphan_result``, a call
  without a result ``unanswered``.
* ``level`` is the topological order: 0 for calls that wait for nothing, else one more than the
  highest level among the calls named in ``after``. Rounds of joins peel the graph by levels,
  as many as the longest chain; calls on a cycle or after one have no level.
* Arguments are checked against the JSON schema of the tool's name (type, required, properties,
  additionalProperties, items, enum, const, bounds of numbers, lengths and item counts).
* The record of a link is canonical JSON: sorted keys, no blanks, numbers as JSON reads them.

Conversations are never gathered: joins are on (conversation, identifier), so a conversation
that holds a third of all turns is spread over its identifiers.

Messages: text that is a JSON object with ``tool_calls`` (list of id, name, arguments, after) or
``tool_call_id`` is read as such. In plain conversations the turn pair is the call: a user turn
calls the tool ``reply`` with its prompt under the identifier ``turn:<n>``, and the assistant turn
after it is the result; plain turns of any other role (``system``, null, unknown) are no event and give
no row, and plain calls wait for nothing. Null conversation ids, turns or texts are carried; rows with a null
conversation, turn or identifier link with nothing; repeated rows are duplicates. Text with NaN or
Infinity, or with numbers no double holds, is not JSON; whole numbers are written without point or exponent.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import id_of, id_text, ids_of
from tidemark.session import cut_lineage

REPLY = {"reply": {"type": "object", "required": ["prompt"], "additionalProperties": False,
                   "properties": {"prompt": {"type": "string", "minLength": 1}}}}
NUMBERS = ("conv_id", "call_turn", "result_turn", "level")
_EVENT = "conv_id long, turn long, call_id string, kind string, name string, body string, after array<string>"


def parse(text: str):
    """JSON as its grammar has it: the names NaN and Infinity are no numbers."""
    def refuse(name):
        raise ValueError(name)

    return json.loads(text, parse_constant=refuse)


def _plain(value):
    """One form per number: whole ones without point or exponent."""
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e21:
        return int(value)
    if isinstance(value, list):
        return [_plain(x) for x in value]
    return {k: _plain(x) for k, x in value.items()} if isinstance(value, dict) else value


def canonical(value) -> str:
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _events(batches):
    for pdf in batches:
        out = []
        for conv, turn, role, text in zip(pdf["conv_id"], pdf["turn"], pdf["role"], pdf["text"]):
            conv, turn = id_of(conv), id_of(turn)
            made = None
            if text is not None and text.lstrip()[:1] == "{":
                try:
                    made = parse(text)
                    canonical(made)  # numbers beyond the range of a double cannot be written again
                except (ValueError, RecursionError):
                    made = None
            if isinstance(made, dict) and isinstance(made.get("tool_calls"), list):
                for c in made["tool_calls"]:
                    c = c if isinstance(c, dict) else {}
                    args = c.get("arguments")
                    after = c.get("after")
                    out.append((conv, turn, None if c.get("id") is None else str(c["id"]), "call", None if c.get("name") is None else str(c["name"]),
                                args if isinstance(args, str) else canonical(args),
                                [str(x) for x in after] if isinstance(after, list) else []))
            elif isinstance(made, dict) and "tool_call_id" in made:
                out.append((conv, turn, None if made["tool_call_id"] is None else str(made["tool_call_id"]), "result", None, canonical(made.get("content")), []))
            elif role == "user":
                out.append((conv, turn, None if turn is None else f"turn:{turn}", "call", "reply", canonical({"prompt": text}), []))
            elif role == "assistant":
                out.append((conv, turn, None if turn is None else f"turn:{turn - 1}", "result", None, canonical(text), []))
        got = pd.DataFrame(out, columns=["conv_id", "turn", "call_id", "kind", "name", "body", "after"], dtype=object)
        yield got.assign(conv_id=pd.array(got["conv_id"], "Int64"), turn=pd.array(got["turn"], "Int64"))


def events(messages: DataFrame) -> DataFrame:
    """messages (conv_id, turn, role, text) -> one row per call and per result."""
    return messages.select(id_text("conv_id").alias("conv_id"), id_text("turn").alias("turn"), "role", "text").mapInPandas(_events, _EVENT)


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Broken rules of a JSON schema, as "path: rule", in order."""
    out = []
    kind = schema.get("type")
    if kind is not None:
        kinds = kind if isinstance(kind, list) else [kind]
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        if not any((k == "number" and number) or (k == "integer" and number and float(value).is_integer())
                   or (k in _TYPES and isinstance(value, _TYPES[k])) for k in kinds):
            return [f"{at}: type"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: enum")
    if "const" in schema and value != schema["const"]:
        out.append(f"{at}: const")
    if isinstance(value, str):
        size, names = len(value), ("minLength", "maxLength")
    elif isinstance(value, list):
        size, names = len(value), ("minItems", "maxItems")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        size, names = value, ("minimum", "maximum")
    else:
        size, names = None, ()
    if names and names[0] in schema and size < schema[names[0]]:
        out.append(f"{at}: {names[0]}")
    if names and names[1] in schema and size > schema[names[1]]:
        out.append(f"{at}: {names[1]}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: required" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: additionalProperties")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{i}]")
    return out


def _records(schemas: dict):
    def run(batches):
        for pdf in batches:
            errors, records = [], []
            for call_id, name, body, result, status in zip(pdf["call_id"], pdf["name"], pdf["body"], pdf["result"], pdf["status"]):
                found, args = [], None
                if status != "orphan_result":
                    try:
                        args = parse(body)
                        canonical(args)
                        if name not in schemas:
                            found = ["$: unknown tool"]
                        else:
                            found = violations(args, schemas[name])
                    except (ValueError, TypeError, RecursionError):
                        found, args = ["$: not JSON"], body
                errors.append(found)
                records.append(canonical({"id": call_id, "name": name, "arguments": args,
                                          "result": None if result is None else json.loads(result), "status": status}))
            yield pdf[["conv_id", "call_id", "name", "call_turn", "result_turn", "status", "level"]].assign(
                **{c: ids_of(pdf[c]) for c in NUMBERS}, errors=errors, record=records)
    return run


def levels(calls: DataFrame) -> DataFrame:
    """calls (conv_id, call_id, after), one row per identifier -> (conv_id, call_id, level).

    Identifiers that no call has are not waited for.
    """
    edges = calls.select("conv_id", "call_id", F.explode(F.array_distinct("after")).alias("on"))
    known = calls.select("conv_id", F.col("call_id").alias("on"))
    edges = cut_lineage(edges.join(known, ["conv_id", "on"]))
    waiting = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"))
    done = calls.join(waiting, ["conv_id", "call_id"], "left_anti").select("conv_id", "call_id", F.lit(0).cast("long").alias("level"))
    if edges.isEmpty():
        return done
    done, turn = cut_lineage(done), 0
    while True:
        ready = (edges.join(done.select("conv_id", F.col("call_id").alias("on"), "level"), ["conv_id", "on"])
                 .groupBy("conv_id", "call_id").agg(F.count("*").alias("have"), (F.max("level") + 1).alias("level"))
                 .join(waiting, ["conv_id", "call_id"]).filter("have = n").drop("have", "n"))
        new = cut_lineage(ready.join(done, ["conv_id", "call_id"], "left_anti"))
        if new.isEmpty():
            return done
        done, turn = done.unionByName(new), turn + 1
        if turn % 8 == 0:
            done = cut_lineage(done)


def link(made: DataFrame, schemas: dict | None = None) -> DataFrame:
    """events -> one row per link, unanswered call, duplicate call and orphan result, with
    conv_id, call_id, name, call_turn, result_turn, status, level, errors and the record."""
    key = ["conv_id", "call_id"]
    named = "conv_id is not null and call_id is not null"
    calls = made.filter("kind = 'call'").select(*key, "turn", "name", "body", "after")
    order = F.struct(F.col("turn").isNull().alias("late"), "turn", "body", "name", "after")
    first = cut_lineage(calls.filter(named).groupBy(*key).agg(F.min(order).alias("c"), F.count("*").alias("calls")))
    one = first.select(*key, F.col("c.turn").alias("call_turn"), F.col("c.name").alias("name"), F.col("c.body").alias("body"), F.col("c.after").alias("after"))
    level = levels(one.select(*key, "after"))
    results = made.filter("kind = 'result'").select(*key, F.col("turn").alias("result_turn"), F.col("body").alias("result"))
    cols = [*key, "name", "body", "call_turn", "result_turn", "result", "status", "level"]
    none = F.lit(None)
    linked = (one.join(level, key, "left").join(results, key, "left")
              .withColumn("status", F.when(F.col("result").isNull(), "unanswered").when(F.col("result_turn") <= F.col("call_turn"), "early_result").otherwise("linked")))
    orphan = results.join(one.select(*key), key, "left_anti").select(
        *key, none.cast("string").alias("name"), none.cast("string").alias("body"), none.cast("long").alias("call_turn"),
        "result_turn", "result", F.lit("orphan_result").alias("status"), none.cast("long").alias("level"))
    # every further call of an identifier, and calls that cannot be identified
    again = (calls.groupBy(*key, "turn", "name", "body", "after").agg(F.count("*").alias("copies"))
             .join(first.select(*[F.col(k).alias(f"_{k}") for k in key], "c"),
                   (F.col("conv_id") == F.col("_conv_id")) & (F.col("call_id") == F.col("_call_id")), "left"))
    own = F.coalesce(order.eqNullSafe(F.col("c")), F.lit(False))
    spare = (again.withColumn("spare", F.col("copies") - own.cast("int")).filter("spare > 0")
             .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("spare")))))
    spare = spare.select(*key, "name", "body", F.col("turn").alias("call_turn"), none.cast("long").alias("result_turn"),
                         none.cast("string").alias("result"), F.when(F.col("c").isNull(), "unidentified").otherwise("duplicate_call").alias("status"),
                         none.cast("long").alias("level"))
    every = linked.select(*cols).unionByName(orphan.select(*cols)).unionByName(spare.select(*cols))
    return every.withColumns({c: id_text(c) for c in NUMBERS}).mapInPandas(_records(REPLY if schemas is None else schemas),
                             "conv_id long, call_id string, name string, call_turn long, result_turn long, status string, "
                             "level long, errors array<string>, record string")
