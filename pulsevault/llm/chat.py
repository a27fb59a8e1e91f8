"""Chat formatting: links tool calls with their results, orders them, validates arguments and serialises canonical JSON.

Calls and results are joined by identifier (an equi-join that may be split, so one conversation with a third of all rows is
no hot task). The order is topological: a call's level is one more than the highest level of the calls its arguments refer
to, and calls that are on a cycle or wait for one get none. Calls that refer to one call are chains: pointers along them are
doubled, so a chain of n calls takes log2(n) rounds of joins. What is left are calls that refer to several; their levels are
raised in rounds, as many as such calls lie behind one another. Arguments are checked against a schema per tool. JSON is
canonical: sorted keys, no blanks, non-ASCII characters as they are.

Rows: a call without a result stays with a null result, a result without a call is dropped; of several results to an
identifier the first by position counts, of several calls likewise; references to unknown calls make a call invalid; null
identifiers link with nothing and such calls are invalid; null or malformed arguments are invalid; empty tables give an empty
result; other columns are ignored. every_turn() drops nothing: each row of a conversation is a call, the result in a call's
message, a result without a call, or a message of another role."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def problems(arguments: str | None, schema: dict | None) -> list[str]:
    """What is wrong with a call's arguments: schema {"properties": {name: {"type": ...}}, "required": [...]}."""
    if schema is None:
        return ["unknown tool"]
    try:
        args = json.loads(arguments)
    except (TypeError, ValueError):
        return ["arguments are no JSON"]
    if not isinstance(args, dict):
        return ["arguments are no object"]
    out = [f"{n} is missing" for n in schema.get("required", []) if n not in args]
    for n, v in args.items():
        kind = schema.get("properties", {}).get(n, {}).get("type")
        if kind is None:
            out.append(f"{n} is unknown")
        elif not isinstance(v, TYPES[kind]) or isinstance(v, bool) and kind != "boolean":
            out.append(f"{n} is no {kind}")
    return sorted(out)


def _first(rows: DataFrame, value: list[str]) -> DataFrame:
    """The first row by position of each (conv_id, call_id), by an aggregate with map-side combine."""
    return rows.groupBy("conv_id", "call_id").agg(F.min(F.struct("position", *value)).alias("r")).select("conv_id", "call_id", "r.*")


def _chains(chain: DataFrame) -> DataFrame:
    """chain (conv_id, call_id, at: the one call that it refers to) -> conv_id, call_id, at (the first call along it that is no
    chain link), dist, open (still a chain link: it is on a cycle or leads to one). Each round doubles the distance."""
    most = chain.groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    link = chain.select("conv_id", F.col("call_id").alias("at"), F.lit(True).alias("open"))
    p = chain.join(link, ["conv_id", "at"], "left").select("conv_id", "call_id", "at", F.lit(1).cast("long").alias("dist"), F.coalesce("open", F.lit(False)).alias("open"))
    p = materialise(p, "chains")
    for _ in range(most.bit_length()):
        if p.where("open").isEmpty():
            break
        further = p.select("conv_id", F.col("call_id").alias("at"), F.col("at").alias("to"), F.col("dist").alias("more"), F.col("open").alias("still"))
        jumped = p.where("open").join(further, ["conv_id", "at"]).select("conv_id", "call_id", F.col("to").alias("at"), (F.col("dist") + F.col("more")).alias("dist"), F.col("still").alias("open"))
        p = materialise(p.where("not open").unionByName(jumped), "chains")
    return p


def _levels(named: DataFrame, needs: DataFrame) -> DataFrame:
    """conv_id, call_id, level of the calls (conv_id, call_id) that are not on a cycle and don't wait for one; needs: conv_id,
    call_id, needed, each pair once."""
    keys = ["conv_id", "call_id"]
    counted = needs.groupBy(*keys).agg(F.count("*").alias("k"), F.min("needed").alias("at"))
    roots = named.join(counted.select(*keys), keys, "left_anti").withColumn("level", F.lit(0).cast("long"))
    chains = _chains(counted.where("k = 1").select(*keys, "at"))
    joints = needs.join(counted.where("k > 1").select(*keys), keys)
    via = chains.select("conv_id", F.col("call_id").alias("needed"), F.col("at").alias("anchor"), "dist", "open")
    left = materialise(joints.join(via, ["conv_id", "needed"], "left").select(*keys, F.coalesce("anchor", "needed").alias("anchor"), F.coalesce("dist", F.lit(0)).alias("dist"), F.coalesce("open", F.lit(False)).alias("open")), "joints")
    done = roots = materialise(roots, "levels")
    while not left.isEmpty():
        # joints all of whose anchors are done by now
        state = left.join(done.select("conv_id", F.col("call_id").alias("anchor"), "level"), ["conv_id", "anchor"], "left")
        ready = state.groupBy(*keys).agg(F.count("level").alias("have"), F.count("*").alias("need"), F.max(F.col("level") + F.col("dist")).alias("top"), F.bool_or("open").alias("open"))
        fresh = materialise(ready.where("have = need and not open").select(*keys, (F.col("top") + 1).alias("level")), "levels")
        if fresh.isEmpty():
            break
        done = done.unionByName(fresh)
        left = materialise(left.join(fresh.select(*keys), keys, "left_anti"), "joints")
    on_chains = chains.where("not open").join(done.select("conv_id", F.col("call_id").alias("at"), "level"), ["conv_id", "at"]).select(*keys, (F.col("level") + F.col("dist")).alias("level"))
    return done.unionByName(on_chains)


def linked_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """conv_id, call_id, level, position, valid, problem, message of each call.

    calls: conv_id, call_id, position, name, arguments (JSON), after (array of the call_ids that it refers to).
    results: conv_id, call_id, position, content."""
    named = materialise(_first(calls.where("conv_id is not null and call_id is not null"), ["name", "arguments", "after"]), "calls")
    nameless = calls.where("conv_id is null or call_id is null").select(*named.columns)
    needs = named.select("conv_id", "call_id", F.explode(F.array_distinct("after")).alias("needed"))
    known = named.select("conv_id", F.col("call_id").alias("needed"), F.lit(True).alias("known"))
    needs = materialise(needs.join(known, ["conv_id", "needed"], "left").select("conv_id", "call_id", "needed", F.coalesce("known", F.lit(False)).alias("known")), "needs")
    dangling = needs.where("not known").select("conv_id", "call_id").distinct().withColumn("dangling", F.lit(True))
    done = _levels(named.select("conv_id", "call_id"), needs.where("known").drop("known"))
    answers = _first(results.where("conv_id is not null and call_id is not null"), ["content"]).drop("position")
    keys = ["conv_id", "call_id"]
    out = named.join(done, keys, "left").join(answers, keys, "left").join(dangling, keys, "left")
    out = out.unionByName(nameless.withColumns({"level": F.lit(None).cast("long"), "content": F.lit(None).cast("string"), "dangling": F.lit(True)}))

    @F.pandas_udf("problem string, message string")
    def render(conv_id: pd.Series, call_id: pd.Series, name: pd.Series, arguments: pd.Series, content: pd.Series, level: pd.Series, dangling: pd.Series) -> pd.DataFrame:
        rows = []
        for c, i, n, a, r, lv, d in zip(conv_id, call_id, name, arguments, content, level, dangling, strict=True):
            wrong = problems(a, schemas.get(n)) + ["refers to an unknown call"] * (d is True or d == True) + ["is on a cycle"] * bool(pd.isna(lv) and not pd.isna(i) and not pd.isna(c))  # noqa: E712
            try:
                args = json.loads(a)
            except (TypeError, ValueError):
                args = a
            call = {"arguments": args, "id": None if pd.isna(i) else i, "name": n, "type": "function"}
            rows.append(("; ".join(wrong) or None, canonical({"call": call, "conversation": None if pd.isna(c) else int(c), "result": None if r is None else {"content": r, "id": i}})))
        return pd.DataFrame(rows, columns=["problem", "message"])

    done_rows = out.withColumn("m", render("conv_id", "call_id", "name", "arguments", "content", "level", "dangling"))
    return done_rows.select("conv_id", "call_id", "level", "position", F.col("m.problem").isNull().alias("valid"), F.col("m.problem").alias("problem"), F.col("m.message").alias("message"))


#: Schemas of the tools that every_turn() calls; of `translate` there is none, so that it is an unknown tool.
TURN_SCHEMAS = {
    "reply": {"properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}, "after": {"type": "array"}}, "required": ["prompt", "turn"]},
    "search": {"properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}, "after": {"type": "array"}, "limit": {"type": "integer"}}, "required": ["prompt", "turn", "limit"]},
}


def _ident(turn: Column | str) -> Column:
    return F.concat_ws(":", "conv_id", turn)


def _user_calls(users: DataFrame) -> DataFrame:
    """Calls of user turns (conv_id, turn, call_id, text, refers: the turn of the call that it refers to, or null). A text of
    several lines is a `search`, whose `limit` is the length of a text of 300 characters or more and else missing; another with
    characters beyond ASCII is a `translate`; all else a `reply`."""
    name = F.when(F.contains("text", F.lit("\n")), "search").when(F.octet_length("text") > F.length("text"), "translate").otherwise("reply")
    after = F.when(F.col("refers").isNotNull(), F.array(_ident("refers"))).otherwise(F.array().cast("array<string>"))
    calls = users.withColumns({"name": F.coalesce(name, F.lit("reply")), "after": after})
    limit = F.when((F.col("name") == "search") & (F.length("text") >= 300), F.length("text")).alias("limit")
    return calls.select("conv_id", "call_id", F.col("turn").alias("position"), "name", F.to_json(F.struct(F.col("text").alias("prompt"), "turn", "after", limit)).alias("arguments"), "after")


def _last_user(turns: DataFrame, block: int = 1024) -> DataFrame:
    """conv_id, turn, last (the last user turn before) of the distinct turns (conv_id, turn, is_user): within blocks of turns,
    then over the blocks, so that a long conversation is no single group."""
    user_turn = F.when(F.col("is_user"), F.col("turn"))
    t = turns.withColumn("block", F.floor(F.col("turn") / block))
    over = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    blocks = t.groupBy("conv_id", "block").agg(F.max(user_turn).alias("top")).withColumn("before", F.max("top").over(over("conv_id").orderBy("block"))).drop("top")
    inside = t.withColumn("inside", F.max(user_turn).over(over("conv_id", "block").orderBy("turn")))
    return inside.join(blocks, ["conv_id", "block"]).select("conv_id", "turn", F.coalesce("inside", "before").alias("last"))


def every_turn(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """conv_id, call_id, level, position, kind, valid, problem, message; every row of conversations is in one row's message.

    call: a user turn, with the first result; it refers to the user turn before it. The first one of a conversation that has a
    system turn of several lines refers to the last one, so that these are a cycle. Of repeated (conv_id, turn) the least text,
    a null last, is `conv_id:turn`; the others are calls with an identifier of their own. result: an assistant turn that is not
    in a call's message, as no user turn is before it or an earlier or lesser assistant turn is the result; invalid. message:
    any other role, without a link; invalid if its role, conversation or turn is null."""
    c = materialise(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"), "turns")
    placed = "conv_id is not null and turn is not null"
    # equal rows are counted and dealt out again, so that no repeated turn is one group
    users = c.where("role = 'user'").where(placed).groupBy("conv_id", "turn", "text").agg(F.count("*").alias("n"))
    least = users.groupBy("conv_id", "turn").agg(F.min("text").alias("least"))
    users = users.join(least, ["conv_id", "turn"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    own = _ident(F.concat_ws(":", "turn", F.coalesce(F.sha1("text"), F.lit("null")), "copy"))
    users = users.select("conv_id", "turn", "text", F.when((F.col("copy") == 1) & F.col("text").eqNullSafe(F.col("least")), _ident("turn")).otherwise(own).alias("call_id"))
    adrift = c.where("role = 'user'").where(f"not ({placed})").select("conv_id", "turn", "text", F.when(F.col("turn").isNotNull(), _ident("turn")).alias("call_id"), F.lit(None).cast("long").alias("refers"))
    turns = c.where(placed).groupBy("conv_id", "turn").agg(F.max(F.coalesce(F.col("role") == "user", F.lit(False))).alias("is_user"))
    lasts = materialise(_last_user(turns), "lasts")
    circular = c.where("role = 'system' and conv_id is not null").where(F.contains("text", F.lit("\n"))).select("conv_id").distinct()
    closing = turns.where("is_user").groupBy("conv_id").agg(F.min("turn").alias("turn"), F.max("turn").alias("back")).join(circular, "conv_id", "left_semi")
    users = users.join(lasts, ["conv_id", "turn"]).join(closing, ["conv_id", "turn"], "left").withColumn("refers", F.coalesce("last", "back")).drop("last", "back")
    calls = _user_calls(users.unionByName(adrift))

    answers = c.where("role = 'assistant'").groupBy("conv_id", "turn", "text").agg(F.count("*").alias("n")).join(lasts, ["conv_id", "turn"], "left")
    answers = materialise(answers, "answers")
    taken = answers.where("last is not null").groupBy("conv_id", "last").agg(F.min(F.struct("turn", "text")).alias("taken"))
    results = taken.select("conv_id", _ident("last").alias("call_id"), F.col("taken.turn").alias("position"), F.col("taken.text").alias("content"))
    spare = answers.join(taken, ["conv_id", "last"], "left").withColumn("n", F.col("n") - F.coalesce(F.struct("turn", "text").eqNullSafe(F.col("taken")), F.lit(False)).cast("long"))
    spare = spare.where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    problem = F.when(F.col("last").isNull(), "has no call").otherwise("call has another result")
    spare = spare.select("conv_id", F.when(F.col("last").isNotNull(), _ident("last")).alias("call_id"), F.col("turn").alias("position"), F.lit("result").alias("kind"), problem.alias("problem"), F.lit("assistant").alias("role"), "text")
    others = c.where("role is null or role not in ('user', 'assistant')")
    problem = F.concat_ws("; ", F.when(F.col("role").isNull(), "has no role"), F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), "has no place"))
    others = others.select("conv_id", F.lit(None).cast("string").alias("call_id"), F.col("turn").alias("position"), F.lit("message").alias("kind"), F.when(problem != "", problem).alias("problem"), "role", "text")

    @F.pandas_udf("string")
    def render(conv_id: pd.Series, kind: pd.Series, role: pd.Series, text: pd.Series) -> pd.Series:
        rows = zip(conv_id, kind, role, text, strict=True)
        return pd.Series([canonical({"conversation": None if pd.isna(i) else int(i), k: {"content": None if pd.isna(t) else t, "role": None if pd.isna(r) else r}}) for i, k, r, t in rows], dtype=object)

    rest = spare.unionByName(others).withColumns({"level": F.lit(None).cast("long"), "valid": F.col("problem").isNull(), "message": render("conv_id", "kind", "role", "text")})
    linked = linked_calls(calls, results, TURN_SCHEMAS if schemas is None else schemas).withColumn("kind", F.lit("call"))
    columns = ["conv_id", "call_id", "level", "position", "kind", "valid", "problem", "message"]
    return linked.select(*columns).unionByName(rest.select(*columns))
