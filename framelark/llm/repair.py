"""Conversation structure repair by Wagner-Fischer target alignment.

The legal role strings are `(s?(ua)+)?`: for each length there is one alternating string, or two of which one
starts with s. The turns of a conversation are aligned with the string of each feasible length; a band of
diagonals, as wide as the cheapest alignment so far allows (Ukkonen), is all that is filled in, and where costs
tie the backtraced audits decide.

A conversation of at most STRETCH turns is one alignment. A longer one is cut into stretches that are aligned
from every state of the grammar they may begin in to every state they may end in; a chain over these summaries,
which hold numbers only, picks the alignments that together are cheapest and have the least audit. Inserts
stand before a turn except at the very end, so that audits of one stretch are never prefixes of each other and
the first stretch in which two chains differ decides.
"""

import hashlib
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common
from framelark.operators.scale import ordinal, split_by_size

STRETCH = 64  # turns that are aligned at once
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_STATE = {"s": AFTER_SYSTEM, "u": AFTER_USER, "a": AFTER_ASSISTANT}
_NAMES = {"u": "user", "a": "assistant"}


# --- alignment -------------------------------------------------------------------------------------------


def _targets(entry: int, most: int):
    """(exit state, target) of every string the grammar allows after `entry`, up to `most` symbols."""
    series = ["auau"] if entry == AFTER_USER else ["uaua"]
    yield entry, ""
    for first in series:
        for n in range(1, most + 1):
            yield _STATE[first[(n - 1) % 2]], (first * (n // 4 + 1))[:n]
    if entry == START:
        for n in range(1, most + 1):
            target = "s" + ("uaua" * (n // 4 + 1))[: n - 1]
            yield _STATE[target[-1]], target


def _gap(x: int) -> int:
    """Least cost of a target that is x symbols longer (or -x shorter) than the turns it takes up."""
    return INSERT * x if x > 0 else -DELETE * x


def _banded(symbols: str, target: str, limit: int, last: bool):
    """(cost, audit) of the cheapest alignment that costs at most `limit`, of equal ones the least audit, or None.

    The diagonal of a cell is its place in the target less the number of turns before it that may stay. The
    path must cross cells whose diagonal leaves the limit room to get there and back.
    """
    n, stay = len(symbols), sum(c != "d" for c in symbols)
    end, slack = len(target) - stay, limit - DELETE * (n - stay)
    if _gap(end) > slack:
        return None
    low, high = min(0, end), max(0, end)
    while _gap(low - 1) + _gap(end - low + 1) <= slack:
        low -= 1
    while _gap(high + 1) + _gap(end - high - 1) <= slack:
        high += 1
    width, far, length = high - low + 1, limit + 1, len(target)
    togo = [far] * width
    for o in range(end, low - 1, -1) if last else (end,):
        j = stay + o  # at the very end only inserts are left
        if j < 0 or "s" in target[j:]:
            break
        togo[o - low] = INSERT * (end - o)
    rows, held = [togo], stay
    for c in reversed(symbols):
        kept = c != "d"
        held -= kept
        new = [far] * width
        extra = TRUNCATED if c.isupper() else 0
        for at in range(width - 1, -1, -1):
            j = held + at + low
            if not 0 <= j <= length:
                continue
            best = togo[at] if not kept else togo[at - 1] if at else far
            best += DELETE
            if j < length:
                symbol = target[j]
                if kept and (c.lower() == symbol or symbol != "s"):
                    best = min(best, togo[at] + extra + (c.lower() != symbol))
                if symbol != "s" and at + 1 < width:
                    best = min(best, new[at + 1] + INSERT)
            new[at] = min(best, far)
        togo = new
        rows.append(togo)
    if togo[-low] > limit:
        return None
    rows.reverse()
    i, at, j, audit = 0, -low, 0, []
    while i < n or j < length:
        cost = rows[i][at]
        if i < n:
            c = symbols[i]
            kept = c != "d"
            if (not kept or at) and rows[i + 1][at - kept] + DELETE == cost:
                i, at = i + 1, at - kept
                audit.append("D")
                continue
        if j < length and target[j] != "s" and at + 1 < width and rows[i][at + 1] + INSERT == cost:
            at, j = at + 1, j + 1
            audit.append("I")
            continue
        same = c.lower() == target[j]
        i, j = i + 1, j + 1
        audit.append("K" if same else "R")
    return rows[0][-low], "".join(audit)


@lru_cache(1 << 16)
def align(symbols: str, entry: int = START, last: bool = True) -> tuple:
    """(exit, cost, audit) for every state in which the turns can leave the grammar, or its best end if `last`.

    symbols: per turn the initial of its role (s, u, a, or x for others), in capitals if it is truncated, and d
    if it must go. The limit on the cost doubles until an alignment keeps to it.
    """
    stay = sum(c != "d" for c in symbols)
    ends = {}
    for exit_, target in _targets(entry, stay + (DELETE * len(symbols) + 2 * INSERT) // INSERT + 1):
        if last and exit_ in (START, AFTER_ASSISTANT) or not last:
            ends.setdefault(START if last else exit_, []).append((_gap(len(target) - stay), exit_, target))
    out = []
    for group in ends.values():
        group.sort()
        base, most = DELETE * (len(symbols) - stay), DELETE * len(symbols) + 2 * INSERT
        room, best = 8, None
        while best is None:
            limit = min(base + room, most)
            for gap, exit_, target in group:
                if base + gap > limit:
                    break
                if (found := _banded(symbols, target, limit, last)) and (best is None or found < best[:2]):
                    best, limit = (*found, exit_), found[0]
            if base + room >= most:
                break
            room *= 2
        if best is not None:
            out.append((best[2], best[0], best[1]))
    return tuple(out)


def edits(symbols: str, entry: int, audit: str) -> list:
    """(turn, role) of each turn that the audit leaves: turn -1 is inserted, role null is the turn's own."""
    out, i, state = [], 0, entry
    for e in audit:
        if e != "D":
            symbol = symbols[i].lower() if e == "K" else "a" if state == AFTER_USER else "u"
            out.append((-1 if e == "I" else i, None if e == "K" else _NAMES[symbol]))
            state = _STATE[symbol]
        i += e != "I"
    return out


# --- Spark -------------------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults: crc32 of `conv_id:turn` modulo 20 drops (0), empties (1), unpunctuates (2), repeats (3) a row or makes its role user (4).

    Nulls count as one space, in that text as in role and text.
    """
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = turns.select(F.col("`conv_id`").alias("conv_id"), F.col("`turn`").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _key():
    """conv_id as text that is never null."""
    return F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit("")).alias("k")


def _judged(groups: DataFrame, seen_before) -> DataFrame:
    """Groups with `rows` (turn, role, text, ...) get symbols, and counts of faults and of illegal neighbours."""
    def code(r, i):
        told = F.rtrim(F.translate(r["text"], "\t\n\x0b\x0c\r", "     "))
        fault = F.when(told == "", "blank").when(seen_before(r, i), "duplicate").when(~F.right(told, F.lit(1)).isin(".", "!", "?"), "truncated")
        return F.struct(fault.alias("fault"), F.substring(r["role"], 1, 1).alias("initial"))

    def symbol(c):
        known = F.when(c["initial"].isin("s", "u", "a"), c["initial"]).otherwise(F.lit("x"))
        return F.when(c["fault"] == "truncated", F.upper(known)).when(c["fault"].isNotNull(), F.lit("d")).otherwise(known)

    out = groups.withColumn("codes", F.transform("rows", code))
    out = out.withColumn("initials", F.col("codes.initial"))
    pairs = F.zip_with(F.slice("initials", 1, F.greatest(F.size("initials") - 1, F.lit(0))), F.slice("initials", 2, F.greatest(F.size("initials"), F.lit(1))), lambda a, b: F.concat(a, b))
    count = lambda fault: F.size(F.filter("codes", lambda c: c["fault"] == fault)).cast("long")
    counts = {fault: count(fault) for fault in ("blank", "duplicate", "truncated")}
    return out.withColumns({"symbols": F.array_join(F.transform("codes", symbol), ""), "illegal": F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long"), **counts}).drop("codes")


_PLAN = "array<struct<entry:int,exit:int,cost:long,audit:string,edits:array<struct<at:int,role:string>>>>"


def _aligned(symbols: str, first, last):
    """Column: the plans of the turns in `symbols`, from each state they may begin in."""

    def plans(s, is_first, is_last):
        entries = (START,) if is_first else (START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT)
        found = [(e, *r) for e in entries for r in align(s, e, bool(is_last))]
        return [{"entry": e, "exit": x, "cost": cost, "audit": audit, "edits": [{"at": at, "role": role} for at, role in edits(s, e, audit)]} for e, x, cost, audit in found]

    def batch(symbols: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([plans(*row) for row in zip(symbols, first, last)])

    return F.pandas_udf(batch, _PLAN)(symbols, first, last)


def _turns_left(plan):
    """Repaired turns (edit place aside) of a plan over `rows`."""
    own = lambda e: F.get(F.col("rows"), e["at"])
    return F.transform(plan["edits"], lambda e: F.struct(F.coalesce(e["role"], own(e)["role"]).alias("role"), F.when(e["at"] < 0, F.lit("")).otherwise(own(e)["text"]).alias("text")))


def _short(rows: DataFrame) -> DataFrame:
    """One alignment a conversation: k, stretch, counts, cost, audit, repaired."""
    per = rows.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
    seen = lambda r, i: F.exists(F.slice("rows", F.lit(1), i), lambda q: (q["role"] == r["role"]) & (q["text"] == r["text"]))
    judged = _judged(per, seen)
    # The one plan is exploded, so that it is computed before expressions over it are.
    judged = judged.select(*judged.columns, F.explode(_aligned("symbols", F.lit(True), F.lit(True))).alias("plan"))
    return judged.select("k", F.lit(0).cast("long").alias("stretch"), "blank", "duplicate", "truncated", "illegal", "plan.cost", "plan.audit", _turns_left(F.col("plan")).alias("repaired"))


def _chain(part: pd.DataFrame) -> pd.DataFrame:
    """The plan of each stretch of one conversation: rows (k, stretch, entry, exit, cost, rank) in, (k, stretch, at) out."""
    part = part.sort_values("stretch", kind="stable")
    stretches, lists = [], []
    for row in part.itertuples(index=False):
        if not stretches or stretches[-1] != row.stretch:
            stretches.append(row.stretch)
            lists.append([])
        lists[-1].append(row)
    togo = [{START: 0, AFTER_ASSISTANT: 0}]
    for rows in reversed(lists):
        now = {}
        for r in rows:
            if r.exit in togo[-1]:
                now[r.entry] = min(now.get(r.entry, r.cost + togo[-1][r.exit]), r.cost + togo[-1][r.exit])
        togo.append(now)
    togo.reverse()
    state, picks = START, []
    for i, rows in enumerate(lists):
        best = min((r for r in rows if r.entry == state and r.exit in togo[i + 1] and r.cost + togo[i + 1][r.exit] == togo[i][state]), key=lambda r: r.rank)
        picks.append(best.at)
        state = best.exit
    return pd.DataFrame({"k": part["k"].iloc[0], "stretch": stretches, "at": picks})


def _long(rows: DataFrame, stretch: int) -> DataFrame:
    """As `_short`, a row per stretch."""
    placed = common.cut(ordinal(rows, ["k"], [F.col("turn").asc_nulls_first(), "role", "text"], "pos"))
    # The first of equal turns is found by partial minima and marked by its place, so a hot turn never meets in one task.
    firsts = placed.groupBy("k", "role", F.md5("text").alias("h")).agg(F.min("pos").alias("pos")).select("k", "pos", F.lit(True).alias("is_first"))
    marked = placed.join(firsts, ["k", "pos"], "left").withColumn("stretch", F.floor(F.col("pos") / stretch))
    per = marked.groupBy("k", "stretch").agg(F.array_sort(F.collect_list(F.struct("pos", "turn", "role", "text", F.coalesce("is_first", F.lit(False)).alias("is_first")))).alias("rows"))
    ends = placed.groupBy("k").agg(F.floor(F.max("pos") / stretch).alias("end"))
    judged = _judged(per, lambda r, i: ~r["is_first"]).join(ends, "k")
    judged = common.cut(judged.withColumn("plans", _aligned("symbols", F.col("stretch") == 0, F.col("stretch") == F.col("end"))))
    ranked = judged.select("k", "stretch", F.posexplode("plans").alias("at", "p"), F.transform("plans", lambda p: F.struct(p["entry"], p["audit"])).alias("all"))
    ranked = ranked.select("k", "stretch", "at", "p.entry", "p.exit", "p.cost", F.array_position(F.array_sort("all"), F.struct("p.entry", "p.audit")).alias("rank"))
    picks = ranked.groupBy("k").applyInPandas(_chain, "k string, stretch long, at int")
    edges = judged.select("k", "stretch", F.get("initials", F.lit(0)).alias("head"), F.element_at("initials", -1).alias("tail"))
    before = edges.select("k", (F.col("stretch") + 1).alias("stretch"), F.col("tail").alias("before"))
    bad = edges.join(before, ["k", "stretch"]).select("k", "stretch", (~F.concat("before", "head").isin("su", "ua", "au")).cast("long").alias("across"))
    found = judged.join(picks, ["k", "stretch"]).join(bad, ["k", "stretch"], "left").withColumn("plan", F.get("plans", F.col("at")))
    return found.select("k", "stretch", "blank", "duplicate", "truncated", (F.col("illegal") + F.coalesce("across", F.lit(0))).alias("illegal"), "plan.cost", "plan.audit", _turns_left(F.col("plan")).alias("repaired"))


def _split(turns: DataFrame, stretch: int):
    rows = turns.select(_key(), "turn", "role", "text")
    small, big = split_by_size(rows, ["k"], stretch)
    return _short(small), None if big is None else _long(big, stretch)


def repair(turns: DataFrame, stretch=STRETCH) -> DataFrame:
    """Repaired conversations of rows (conv_id, turn, role, text), in order: k (":" and conv_id, or "" for null), stretch, place, role, text.

    Turns go by number (null first), then role and text. Blank turns and repeats of an earlier turn's role and
    text go; other turns are kept, given another role or deleted, and empty turns inserted, at least cost.
    A role without a first letter fits nowhere. Null roles and texts count as empty. Conversations that lose
    all turns have no rows; an empty table gives an empty one.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    parts = [p for p in _split(turns, stretch) if p is not None]
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return whole.select("k", "stretch", F.posexplode("repaired").alias("place", "t")).select("k", "stretch", "place", "t.role", "t.text")


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _digests(batches):
    """Conversations whose stretches arrive in order: sums of the counts, the whole audit and the hash of the repaired text."""
    now, out = None, []

    def close():
        out.append({"k": now["k"], **now["sums"], "audit": "".join(now["audit"]), "repaired_sha256": now["hash"].hexdigest()})

    for batch in batches:
        for row in batch.to_pylist():
            if now is None or now["k"] != row["k"]:
                if now is not None:
                    close()
                now = {"k": row["k"], "sums": dict.fromkeys(_COUNTS, 0), "audit": [], "hash": hashlib.sha256(), "some": False}
            for c in _COUNTS:
                now["sums"][c] += row[c]
            now["audit"].append(row["audit"])
            if row["said"] is not None:
                now["hash"].update((b"\n" if now["some"] else b"") + row["said"].encode())
                now["some"] = True
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)
            out.clear()
    if now is not None:
        close()
        yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)


_DIGEST = pa.schema([("k", pa.string()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def report(conversations: DataFrame, stretch=STRETCH) -> DataFrame:
    """One row per conv_id of the table (null is one): conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The rows are damaged first. A conversation without rows after that has zeros, an empty audit and the hash of
    the empty text. The audit of a conversation is one string and its hash runs over its turns in order, so both
    end in one task, which streams the stretches and holds the audit alone.
    """
    turns = damage(conversations)
    short, long = _split(turns, stretch)
    said = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    done = short.select("k", *_COUNTS, "audit", F.sha2(said, 256).alias("repaired_sha256"))
    if long is not None:
        rows = long.select("k", "stretch", *_COUNTS, "audit", F.when(F.size("repaired") > 0, said).alias("said"))
        streamed = rows.repartition("k").sortWithinPartitions("k", "stretch").drop("stretch")
        done = done.unionByName(streamed.mapInArrow(_digests, "k string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"))
    spans = turns.groupBy(_key(), "turn").agg(F.lit(1)).groupBy("k").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    every = conversations.select(F.col("`conv_id`").alias("conv_id")).distinct().withColumn("k", _key())
    out = every.join(spans, "k", "left").join(done, "k", "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS)],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
