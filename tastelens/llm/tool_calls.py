"""Tool-call linking for chat transcripts.

Calls and results are joined by identifier, ordered topologically by what they depend on, checked
against the schemas of their tools and written as canonical JSON.
"""

from __future__ import annotations

import json
import re
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tastelens.session import cut

# Schemas are sent to every task while they have at most so many characters together; beyond
# that they are joined by the name of the tool.
MOST_SCHEMA_CHARS = 4_000_000
# Calls that need several others are ordered in segments of 2**SEGMENT_BITS neighbours.
SEGMENT_BITS = 14

_KINDS = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None),
}


def _is(value, kind: str) -> bool:
    if kind == "integer":
        return not isinstance(value, bool) and (
            isinstance(value, int) or isinstance(value, float) and value.is_integer()
        )
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, _KINDS[kind]) if kind in _KINDS else True


def _same(a, b) -> bool:
    """Equality of JSON values: true is not 1, but 1 is 1.0."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(v, b[k]) for k, v in a.items())
    return a == b


def _count(value) -> bool:
    return _is(value, "integer") and value >= 0


def _names(value) -> bool:
    return isinstance(value, list) and all(isinstance(v, str) for v in value)


def _pattern(value) -> bool:
    try:
        re.compile(value)
        return isinstance(value, str)
    except (TypeError, ValueError, re.error, RecursionError):
        return False


# What the value of each keyword of a schema must be, so that a value can be checked against it.
_KEYWORDS = {
    "type": lambda v: isinstance(v, str) or _names(v),
    "enum": lambda v: isinstance(v, list),
    **dict.fromkeys(
        ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"), lambda v: _is(v, "number")
    ),
    "multipleOf": lambda v: _is(v, "number") and v > 0,
    **dict.fromkeys(("minLength", "maxLength", "minItems", "maxItems"), _count),
    "pattern": _pattern,
    "required": _names,
    "properties": lambda v: isinstance(v, dict),
    **dict.fromkeys(("anyOf", "oneOf", "allOf"), lambda v: isinstance(v, list) and bool(v)),
}


def sound(schema) -> bool:
    """Whether a schema, and all schemas inside it, can be checked against."""
    if isinstance(schema, bool):
        return True
    if not isinstance(schema, dict) or "$ref" in schema:
        return False
    if not all(fits(schema[k]) for k, fits in _KEYWORDS.items() if k in schema):
        return False
    inner = [*schema.get("properties", {}).values()]
    inner += [s for k in ("anyOf", "oneOf", "allOf") for s in schema.get(k, ())]
    inner += [schema[k] for k in ("items", "additionalProperties", "not") if k in schema]
    return all(map(sound, inner))


def violations(value, schema, path: str = "$") -> list[str]:
    """Where a value departs from a sound JSON schema: type, enum, const, bounds, lengths,
    patterns, required and further properties, items, anyOf, oneOf, allOf and not."""
    if schema is False:
        return [f"{path}: none allowed"]
    if not isinstance(schema, dict):
        return []
    wanted = schema.get("type")
    kinds = [wanted] if isinstance(wanted, str) else wanted or []
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{path}: type"]
    broken = []
    if "enum" in schema and not any(_same(value, v) for v in schema["enum"]):
        broken.append("enum")
    if "const" in schema and not _same(value, schema["const"]):
        broken.append("const")
    tests = ()
    if _is(value, "number"):
        tests = (
            ("minimum", lambda bound: value >= bound),
            ("maximum", lambda bound: value <= bound),
            ("exclusiveMinimum", lambda bound: value > bound),
            ("exclusiveMaximum", lambda bound: value < bound),
            ("multipleOf", lambda step: Fraction(str(value)) % Fraction(str(step)) == 0),
        )
    elif isinstance(value, str):
        tests = (
            ("minLength", lambda size: len(value) >= size),
            ("maxLength", lambda size: len(value) <= size),
            ("pattern", lambda pattern: re.search(pattern, value)),
        )
    elif isinstance(value, list):
        tests = (
            ("minItems", lambda size: len(value) >= size),
            ("maxItems", lambda size: len(value) <= size),
        )
    broken += [name for name, holds in tests if name in schema and not holds(schema[name])]
    for name, fits in (
        ("anyOf", lambda n, _: n >= 1), ("oneOf", lambda n, _: n == 1), ("allOf", lambda n, m: n == m)
    ):
        if name in schema:
            passed = sum(not violations(value, s, path) for s in schema[name])
            broken += [] if fits(passed, len(schema[name])) else [name]
    if "not" in schema and not violations(value, schema["not"], path):
        broken.append("not")
    found = [f"{path}: {name}" for name in broken]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        further = schema.get("additionalProperties", True)
        found += [f"{path}.{k}: required" for k in schema.get("required", ()) if k not in value]
        for name in sorted(value):
            if name in known:
                found += violations(value[name], known[name], f"{path}.{name}")
            elif further is False:
                found.append(f"{path}.{name}: additional")
            else:
                found += violations(value[name], further, f"{path}.{name}")
    if isinstance(value, list):
        for place, item in enumerate(value):
            found += violations(item, schema.get("items"), f"{path}[{place}]")
    return found


def _no_constant(name: str):
    raise ValueError(name)


def _no_repeats(pairs):
    made = dict(pairs)
    if len(made) != len(pairs):
        raise ValueError("repeated name")
    return made


def canonical(value) -> str:
    """JSON without spaces, names in code-point order, characters unescaped where JSON lets them."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def read_json(text: str | None):
    """(value, whether the text is JSON with finite numbers and no name twice)."""
    try:
        value = json.loads(
            text or "", parse_constant=_no_constant, object_pairs_hook=_no_repeats
        )
        canonical(value).encode()
        json.dumps(value, allow_nan=False)
        return value, True
    except (ValueError, RecursionError):
        return None, False


def _anchored(chain: DataFrame) -> DataFrame:
    """(call_id, anchor, steps): the first call off the chains that each call of a chain leads to.

    ``chain``: call_id, needs, one row per call of a chain. Pointers are doubled, so a chain of n
    calls takes about log2(n) rounds; calls that lead into a cycle are left out.
    """
    chain = cut(chain)
    members = chain.select(F.col("call_id").alias("needs"), F.lit(True).alias("on"))
    state = cut(
        chain.join(members, "needs", "left").select(
            "call_id", F.col("needs").alias("anchor"), F.lit(1).alias("steps"),
            F.col("on").isNotNull().alias("open"),
        )
    )
    # a chain has no more calls than there are, so whatever is open beyond that is on a cycle
    total, reach = state.count(), 1
    while reach <= total and state.filter("open").limit(1).count():
        jump = state.select(
            F.col("call_id").alias("anchor"), F.col("anchor").alias("far"),
            F.col("steps").alias("more"), F.col("open").alias("still"),
        )
        moved = state.filter("open").join(jump, "anchor").select(
            "call_id", F.col("far").alias("anchor"), (F.col("steps") + F.col("more")).alias("steps"),
            F.col("still").alias("open"),
        )
        state = cut(state.filter(~F.col("open")).union(moved))
        reach *= 2
    return state.filter(~F.col("open")).drop("open")


def _segments(calls: DataFrame, count: int) -> DataFrame:
    """(call_id, segment): neighbours by conversation and turn, 2**SEGMENT_BITS calls at most.

    Ranges end in the identifier, so that a conversation of any size is split.
    """
    order = ["conv_id", "turn", "call_id"]
    ranges = count // 2 ** (SEGMENT_BITS + 4) + 1
    placed = calls.select(*order).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return placed.select(
        "call_id", F.shiftright(F.monotonically_increasing_id(), SEGMENT_BITS).alias("segment")
    )


def _settle(key, table):
    """Levels of the calls of one segment whose needs are known or settled within the segment.

    ``table``: call_id, anchor, steps, level, one row per need, ``level`` what the need asks for
    or null while it is not known.
    """
    calls, anchors, steps, levels = (
        table.column(c).to_pylist() for c in ("call_id", "anchor", "steps", "level")
    )
    best: dict[str, int] = {}
    open_needs: dict[str, int] = {}
    asked: dict[str, list] = {}
    for call, anchor, step, level in zip(calls, anchors, steps, levels):
        open_needs.setdefault(call, 0)
        if level is None:
            open_needs[call] += 1
            asked.setdefault(anchor, []).append((call, step))
        else:
            best[call] = max(level, best.get(call, 0))
    ready = [call for call, needs in open_needs.items() if not needs]
    for call in ready:
        for user, step in asked.get(call, ()):
            best[user] = max(best[call] + step, best.get(user, 0))
            open_needs[user] -= 1
            if not open_needs[user]:
                ready.append(user)
    return pa.table(
        {"call_id": pa.array(ready, pa.string()), "level": pa.array([best[c] for c in ready], pa.int32())}
    )


def _levels(calls: DataFrame) -> DataFrame:
    """(call_id, level): the calls on the longest chain of known dependencies below each call.

    Calls that need one other call are led along their chains by pointer doubling. What remains,
    calls that need several, is cut into segments of neighbouring turns; a round settles all that
    can be settled within every segment at once, so there are as many rounds as a chain of needs
    passes from segment to segment. Calls on a cycle, and those behind it, get no level.
    """
    names = calls.select("call_id")
    edges = calls.select("call_id", F.explode("depends_on").alias("needs"))
    edges = cut(edges.join(names.withColumnRenamed("call_id", "needs"), "needs", "left_semi"))
    degree = edges.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("needs").alias("needs"))
    degree = cut(degree)
    chains = cut(_anchored(degree.filter("n = 1").select("call_id", "needs")))
    done = names.join(degree, "call_id", "left_anti").withColumn("level", F.lit(0))
    several = degree.filter("n > 1").select("call_id")
    count = several.count()
    if count:
        # every need gives way to its anchor; one that leads into a cycle keeps no anchor
        segments = cut(_segments(calls.join(several, "call_id", "left_semi"), count))
        whole = edges.join(segments, "call_id")
        single = degree.filter("n = 1").select(F.col("call_id").alias("needs"), F.lit(True).alias("on"))
        ends = chains.select(F.col("call_id").alias("needs"), "anchor", "steps")
        waiting = cut(
            whole.join(single, "needs", "left").join(ends, "needs", "left").select(
                "segment", "call_id",
                F.when(F.col("on").isNull(), F.col("needs")).otherwise(F.col("anchor")).alias("anchor"),
                (F.coalesce("steps", F.lit(0)) + 1).alias("steps"),
                F.lit(None).cast("int").alias("level"),
            )
        )
        done = ready = cut(done)
        rounds = 0
        while True:
            known = ready.select(F.col("call_id").alias("anchor"), F.col("level").alias("below"))
            waiting = cut(
                waiting.join(known, "anchor", "left").select(
                    "segment", "call_id", "anchor", "steps",
                    F.coalesce("level", F.col("below") + F.col("steps")).alias("level"),
                )
            )
            ready = cut(waiting.groupBy("segment").applyInArrow(_settle, "call_id string, level int"))
            if not ready.limit(1).count():
                break
            rounds += 1
            done = done.union(ready)
            done = cut(done) if rounds % 32 == 0 else done
            waiting = waiting.join(ready.select("call_id"), "call_id", "left_anti")
    below = done.select(F.col("call_id").alias("anchor"), "level")
    led = chains.join(below, "anchor").select("call_id", (F.col("level") + F.col("steps")).alias("level"))
    return done.union(led)


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call identifier, and per result identifier that no call has.

    ``calls``: call_id, conv_id, turn, name, arguments (JSON text), depends_on (array of call_id);
    ``results``: call_id, turn, content; ``schemas``: name, schema (JSON text). Other columns are
    ignored. Calls that repeat an identifier count in ``n_calls``, the first (smallest turn, name,
    arguments) stands for them; likewise ``n_results`` and the result of the smallest turn and
    content. Rows without an identifier cannot be linked: their calls come back one by one as
    ``unnamed``, their results are left out.

    Returns call_id, conv_id, turn, name, n_calls, n_results, status (answered, unanswered,
    orphan, unnamed), level (the calls on the longest chain of calls that it waits for, 0 if
    it waits for none; null on a cycle, behind one and for rows without a call or identifier),
    missing (dependencies that are no call), errors (array, empty if the arguments fit the schema) and record, the canonical JSON of call and result, null if
    the arguments are no JSON. A call without schema has the error ``no schema``, as one whose
    schema is no JSON; one whose schema holds a keyword of the wrong kind, or a reference, has ``bad
    schema``; of schemas that repeat a name the smallest text counts. Empty tables give
    no rows of their kind.
    """
    fields = ["conv_id", "turn", "name", "arguments", "depends_on"]
    depends = F.coalesce("depends_on", F.array().cast("array<string>"))
    known = calls.select(
        F.col("call_id").cast("string"), "conv_id", "turn", "name", "arguments",
        F.array_sort(F.array_distinct(F.filter(depends, lambda d: d.isNotNull()))).alias("depends_on"),
    )
    order = F.struct("turn", "name", "arguments", "conv_id", "depends_on")
    first = (
        known.filter(F.col("call_id").isNotNull())
        .groupBy("call_id")
        .agg(F.min(order).alias("c"), F.count(F.lit(1)).alias("n_calls"))
        .select("call_id", *(F.col(f"c.{f}").alias(f) for f in fields), "n_calls")
    )
    first = cut(first)
    answers = (
        results.filter(F.col("call_id").isNotNull())
        .groupBy(F.col("call_id").cast("string").alias("call_id"))
        .agg(
            F.min(F.struct("turn", "content"))["content"].alias("content"),
            F.count(F.lit(1)).alias("n_results"),
        )
    )
    needed = first.select("call_id", F.explode("depends_on").alias("needs"))
    absent = needed.join(first.select(F.col("call_id").alias("needs")), "needs", "left_anti")
    absent = absent.groupBy("call_id").agg(F.count(F.lit(1)).alias("missing"))
    linked = (
        first.join(_levels(first), "call_id", "left")
        .join(absent, "call_id", "left")
        .join(answers, "call_id", "full")
        .withColumn(
            "status",
            F.when(F.col("n_calls").isNull(), "orphan")
            .when(F.col("n_results").isNull(), "unanswered")
            .otherwise("answered"),
        )
    )
    unnamed = known.filter(F.col("call_id").isNull()).select(
        "call_id", *fields, F.lit(1).cast("bigint").alias("n_calls"),
        F.lit(None).cast("int").alias("level"), F.lit(0).cast("bigint").alias("missing"),
        F.lit(None).cast("string").alias("content"), F.lit(0).cast("bigint").alias("n_results"),
        F.lit("unnamed").alias("status"),
    )
    linked = linked.unionByName(unnamed)
    plans = schemas.filter(F.col("name").isNotNull()).groupBy("name").agg(
        F.min("schema").alias("schema")
    )
    size = plans.agg(F.sum(F.length("schema"))).first()[0] or 0
    plans = F.broadcast(plans) if size <= MOST_SCHEMA_CHARS else plans
    linked = linked.join(plans, "name", "left")
    kept = ["call_id", "conv_id", "turn", "name", "n_calls", "n_results", "status", "level", "missing"]

    def check(batches):
        remembered: dict[str | None, tuple] = {}
        for batch in batches:
            errors, records = [], []
            rows = batch.select(["call_id", "name", "arguments", "content", "schema", "status"])
            for row in rows.to_pylist():
                if row["status"] == "orphan":
                    errors.append(["no call"])
                    records.append(
                        canonical({"id": row["call_id"], "result": row["content"]})
                    )
                    continue
                if row["schema"] not in remembered:
                    if len(remembered) > 10_000:
                        remembered.clear()
                    schema, usable = read_json(row["schema"])
                    fault = None if usable else ["no schema"]
                    remembered[row["schema"]] = schema, fault or (None if sound(schema) else ["bad schema"])
                schema, fault = remembered[row["schema"]]
                value, valid = read_json(row["arguments"])
                if not valid:
                    errors.append(["$: json"])
                    records.append(None)
                    continue
                errors.append(fault or violations(value, schema))
                records.append(
                    canonical(
                        {
                            "arguments": value,
                            "id": row["call_id"],
                            "name": row["name"],
                            "result": row["content"],
                        }
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(errors, pa.list_(pa.string())), pa.array(records, pa.string())],
                names=kept + ["errors", "record"],
            )

    counted = linked.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("n_calls", "n_results", "missing")}
    )
    columns = kept + ["arguments", "content", "schema"]
    schema = counted.select(*kept).schema.add("errors", ArrayType(StringType()))
    schema = schema.add("record", StringType())
    return counted.select(*columns).mapInArrow(check, schema)
