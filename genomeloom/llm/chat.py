"""Tool-call linking.

Calls and results meet in a hash join on conversation and call identifier. A call may name the call it
comes after; depth in that order is found by pointer doubling, so a chain of any length takes
logarithmically many rounds. Arguments are checked against the tool's schema and each event is written as
canonical JSON.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import spread
from ..session import materialize

# Turns of a conversation that are put in order by one task.
CHUNK = 1024

TOOLS = {
    "search": {
        "type": "object",
        "properties": {
            "query": {"type": "string", "minLength": 1, "maxLength": 4000},
            "limit": {"type": "integer", "minimum": 1, "maximum": 100},
        },
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "properties": {
            "text": {"type": "string"},
            "target": {"type": "string", "enum": ["de", "en", "es", "fr"]},
        },
        "required": ["text", "target"],
        "additionalProperties": False,
    },
    "count": {
        "type": "object",
        "properties": {
            "words": {"type": "array", "items": {"type": "string"}, "maxItems": 500},
            "ratio": {"type": "number", "minimum": 0, "maximum": 1},
        },
        "required": ["words"],
    },
}

CHECKS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
    "number": lambda v: not isinstance(v, bool) and isinstance(v, (int, float)),
}


def faults(value: object, schema: dict, path: str = "$") -> list[str]:
    """What ``value`` breaks of a schema: type, enum, bounds, lengths, required and further properties, items."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds or []
    if kinds and not any(CHECKS[k](value) for k in kinds):
        return [f"{path}: not {'/'.join(kinds)}"]
    out = []
    if "enum" in schema and not any(value == e and type(value) is type(e) for e in schema["enum"]):
        out.append(f"{path}: not in enum")
    if CHECKS["number"](value):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{path}: below {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{path}: above {schema['maximum']}")
    for kind, low, high in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems")):
        if isinstance(value, kind):
            if len(value) < schema.get(low, 0):
                out.append(f"{path}: shorter than {schema[low]}")
            if len(value) > schema.get(high, math.inf):
                out.append(f"{path}: longer than {schema[high]}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k, v in value.items():
            if k in known:
                out += faults(v, known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{k}: not known")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += faults(v, schema["items"], f"{path}[{i}]")
    return out


def _number(value: float) -> str:
    """The shortest decimal form, without exponent from 1e-6 up to 1e21."""
    if not math.isfinite(value):
        raise ValueError("not a JSON number")
    if value == 0:
        return "0"
    sign = "-" if value < 0 else ""
    digits, _, power = repr(abs(value)).partition("e")
    whole, _, part = digits.partition(".")
    part = part if part != "0" else ""
    point = len(whole) + int(power or 0)
    bare = whole + part
    lead = len(bare) - len(bare.lstrip("0"))
    bare, point = bare.lstrip("0"), point - lead
    bare = bare.rstrip("0")
    if 0 < point <= 21:
        body = bare.ljust(point, "0")[:point] + ("." + bare[point:] if len(bare) > point else "")
    elif -6 < point <= 0:
        body = "0." + "0" * -point + bare
    else:
        body = bare[0] + ("." + bare[1:] if len(bare) > 1 else "") + f"e{point - 1:+d}"
    return sign + body


def canonical(value: object) -> str:
    """JSON with keys in UTF-16 order, no white space, least escapes and shortest numbers."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        return _number(value)
    return json.dumps(value, ensure_ascii=False)


def _unique(pairs: list[tuple[str, object]]) -> dict:
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError("repeated key")
    return dict(pairs)


def depths(calls: DataFrame) -> DataFrame:
    """(conv, call_id, depth, loop) of calls (conv, call_id, after): steps to a call that comes after none.

    A named call that does not exist counts as none. ``loop``: the call is in a circle or behind one; its depth is null.
    """
    own = calls.select("conv", "call_id")
    known = own.select(F.col("conv").alias("c"), F.col("call_id").alias("p"))
    linked = calls.join(known, (F.col("conv") == F.col("c")) & (F.col("after") == F.col("p")), "left").select(
        "conv", "call_id", F.col("p").alias("up"), F.col("p").isNotNull().cast("long").alias("depth")
    )
    state = materialize(linked, "depth")
    rounds = max(1, math.ceil(math.log2(max(2, state.count())))) + 1
    for _ in range(rounds):
        if state.where(F.col("up").isNotNull()).isEmpty():
            break
        above = state.select(
            F.col("conv").alias("c"), F.col("call_id").alias("p"), F.col("up").alias("next"), F.col("depth").alias("more")
        )
        moved = state.join(above, (F.col("conv") == F.col("c")) & (F.col("up") == F.col("p")), "left")
        state = materialize(
            moved.select(
                "conv", "call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "depth",
        )
    loop = F.col("up").isNotNull()
    return state.select("conv", "call_id", F.when(~loop, F.col("depth")).alias("depth"), loop.alias("loop"))


def link_calls(
    calls: DataFrame, results: DataFrame, tools: dict[str, dict] = TOOLS, others: DataFrame | None = None
) -> DataFrame:
    """One row per call, per result that answers none and per other turn, in order inside its conversation.

    ``calls``: conv, call_id, turn, name, arguments (JSON text), after (call_id or null). ``results``: conv,
    call_id, turn, content. ``others``: conv, turn, role, content of turns that are neither. Columns out: conv, position (0 up), call_id, turn, name, depth, status
    (answered, unanswered, orphan, message), repeats (further calls and results of the identifier), valid,
    problems, result_turn, json.

    Of calls, or results, with one identifier the first turn counts (then the smallest text). Order: depth, then turn,
    then identifier; orphans and circles come last, at their turn. Other turns are messages: they follow
    the depth of the last call before their turn, without identifier and checks, their role in the JSON; one without conversation or turn has no position. Rows
    without conversation or identifier cannot be linked: each is a row of its own with status ``orphan`` and no position. Arguments that are not JSON,
    repeat a key or break the schema, unknown tools, unknown or circular predecessors are problems, not
    errors. Other columns do not enter. Empty tables give an empty one.
    """
    named = F.col("conv").isNotNull() & F.col("call_id").isNotNull()
    nothing = F.lit(None).cast("string")
    firsts = (
        calls.where(named)
        .groupBy("conv", "call_id")
        .agg(
            F.min(F.struct("turn", "name", "arguments", "after")).alias("call"), F.count("*").alias("calls")
        )
    )
    answers = (
        results.where(named)
        .groupBy("conv", "call_id")
        .agg(F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("results"))
    )
    firsts = materialize(firsts, "calls")
    order = depths(firsts.select("conv", "call_id", F.col("call.after").alias("after")))
    joined = (
        firsts.join(order, ["conv", "call_id"])
        .join(answers, ["conv", "call_id"], "full")
        .select(
            "conv",
            "call_id",
            F.coalesce("call.turn", "result.turn").alias("turn"),
            F.col("call.name").alias("name"),
            F.col("call.arguments").alias("arguments"),
            F.col("call.after").alias("after"),
            "depth",
            F.coalesce("loop", F.lit(False)).alias("loop"),
            F.when(F.col("call").isNull(), F.lit("orphan"))
            .when(F.col("result").isNull(), F.lit("unanswered"))
            .otherwise(F.lit("answered"))
            .alias("status"),
            (F.coalesce("calls", F.lit(1)) - 1 + F.coalesce("results", F.lit(1)) - 1).alias("repeats"),
            F.col("result.turn").alias("result_turn"),
            F.col("result.content").alias("content"),
        )
    )
    parents = firsts.select(F.col("conv").alias("pc"), F.col("call_id").alias("pi"))
    checked = (
        joined.join(parents, (F.col("conv") == F.col("pc")) & (F.col("after") == F.col("pi")), "left")
        .withColumn("lost", F.col("after").isNotNull() & F.col("pi").isNull())
        .drop("pc", "pi")
    )
    checked = checked.withColumn("role", nothing)
    if others is not None:
        messages = others.select("conv", F.col("turn").cast("bigint").alias("turn"), "role", "content").withColumns(
            {
                "depth": F.lit(None).cast("bigint"),
                "loop": F.lit(False),
                "status": F.lit("message"),
                "repeats": F.lit(0).cast("bigint"),
                "lost": F.lit(False),
            }
        )
        in_order = F.col("conv").isNotNull() & F.col("turn").isNotNull()
        checked = checked.unionByName(messages.where(in_order), allowMissingColumns=True)
    staged = materialize(checked, "linked")
    turn = F.coalesce("turn", F.lit(-1)).cast("long")
    staged = staged.withColumn("__t", turn)
    at = F.col("depth")
    if others is not None:
        block = F.floor(F.col("__t") / CHUNK)
        staged = materialize(spread.carry_forward(staged, ["conv"], ["__t", "call_id"], block, at, "__c"), "carried")
        at = F.when(F.col("status") == "message", F.coalesce("__c", F.lit(0))).otherwise(at)
        staged = staged.withColumn("__d", at).drop("__c")
        at = F.col("__d")
    placed = spread.ordinal(
        staged.withColumn("__d", F.coalesce(at, F.lit(2**62))),
        ["conv"],
        ["__d", "__t", "call_id", "role", "content"],
        F.struct(F.col("__d").alias("d"), F.floor(F.col("__t") / CHUNK).alias("t")),
        "position",
    ).drop("__d", "__t")
    loose = [
        calls.where(~named).select(
            "conv", "call_id", "turn", "name", "arguments", "after", nothing.alias("content"), F.lit(None).cast("bigint").alias("result_turn")
        ),
        results.where(~named).select(
            "conv", "call_id", "turn", nothing.alias("name"), nothing.alias("arguments"), nothing.alias("after"), "content", F.col("turn").alias("result_turn")
        ),
    ]
    fixed = {
        "depth": F.lit(None).cast("bigint"),
        "loop": F.lit(False),
        "status": F.lit("orphan"),
        "repeats": F.lit(0).cast("bigint"),
        "lost": F.lit(False),
        "position": F.lit(None).cast("bigint"),
    }
    fixed["role"] = nothing
    whole = placed.unionByName(loose[0].withColumns(fixed)).unionByName(loose[1].withColumns(fixed))
    if others is not None:
        whole = whole.unionByName(messages.where(~in_order), allowMissingColumns=True)
    return _written(whole, tools)


def _written(events: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """Check the arguments and write each event."""
    conv_type = events.schema["conv"].dataType.simpleString()
    kept = ["conv", "position", "call_id", "turn", "name", "depth", "status", "repeats", "result_turn"]
    source = events.select(*kept, "arguments", "after", "content", "loop", "lost", "role").withColumns(
        {c: F.col(c).cast("long") for c in ("position", "turn", "depth", "repeats", "result_turn")}
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, problems, texts = [], [], []
            for e in batch.to_pylist():
                found, arguments = [], None
                if e["status"] == "message":
                    texts.append(canonical({"content": e["content"], "role": e["role"], "status": "message"}))
                    valid.append(True)
                    problems.append(found)
                    continue
                if e["status"] != "orphan" or e["name"] is not None:
                    try:
                        arguments = json.loads(e["arguments"] or "", object_pairs_hook=_unique)
                        written = canonical(arguments)
                    except (ValueError, RecursionError):
                        found.append("$: not JSON")
                        arguments, written = None, "null"
                    else:
                        if e["name"] in tools:
                            found += faults(arguments, tools[e["name"]])
                    if e["name"] not in tools:
                        found.append("unknown tool")
                else:
                    written = "null"
                if e["lost"]:
                    found.append("unknown predecessor")
                if e["loop"]:
                    found.append("circular predecessor")
                body = {"call_id": e["call_id"], "name": e["name"], "result": e["content"], "status": e["status"]}
                texts.append(f'{{"arguments":{written},' + canonical(body)[1:])
                valid.append(not found and e["status"] != "orphan")
                problems.append(found)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(kept))],
                    pa.array(valid, pa.bool_()),
                    pa.array(problems, pa.list_(pa.string())),
                    pa.array(texts, pa.string()),
                ],
                [*kept, "valid", "problems", "json"],
            )

    return source.mapInArrow(
        write,
        f"conv {conv_type}, position long, call_id string, turn long, name string, depth long, status string, "
        "repeats long, result_turn long, valid boolean, problems array<string>, json string",
    )


def calls_of(turns: DataFrame) -> DataFrame:
    """Each user turn of ``turns`` (conv_id, turn, role, text) as a call of the tool that its text picks.

    It comes after the call two turns earlier, if that was one.
    """
    text = F.coalesce("text", F.lit(""))
    pick = F.pmod(F.crc32(text.cast("binary")), F.lit(4))
    words = F.split(text, " ")
    targets = F.array(*[F.lit(x) for x in ("de", "en", "es", "fr", "it")])
    arguments = (
        F.when(pick == 0, F.to_json(F.struct(text.alias("query"), F.size(words).alias("limit"))))
        .when(pick == 1, F.to_json(F.struct(F.get(targets, F.length(text) % 5).alias("target"), text.alias("text"))))
        .when(pick == 2, F.to_json(F.struct(words.alias("words"), (F.size(words) / 64).alias("ratio"))))
        .otherwise(text)
    )
    name = F.get(F.array(*[F.lit(x) for x in ("search", "translate", "count", "browse")]), pick.cast("int"))
    id_at = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    return turns.where("role = 'user'").select(
        F.col("conv_id").alias("conv"),
        id_at(F.col("turn")).alias("call_id"),
        F.col("turn").cast("long").alias("turn"),
        name.alias("name"),
        arguments.alias("arguments"),
        F.when(F.col("turn") >= 2, id_at(F.col("turn") - 2)).alias("after"),
    )


def results_of(turns: DataFrame) -> DataFrame:
    """Each assistant turn as the result of the call one turn earlier."""
    call = F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string"))
    return turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"),
        call.alias("call_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("text").alias("content"),
    )


def others_of(turns: DataFrame) -> DataFrame:
    """Each turn that is neither: of any other role, or of none."""
    return turns.where("role is null or role not in ('user', 'assistant')").select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", F.col("text").alias("content")
    )


def op5_linked_tool_calls(turns: DataFrame) -> DataFrame:
    """Every turn of ``conversations`` as call, result or message; a null text counts as empty; null ids, turns and repeats as in ``link_calls``."""
    linked = link_calls(calls_of(turns), results_of(turns), others=others_of(turns))
    return linked.withColumnRenamed("conv", "conv_id")
