"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation longer than the budget becomes several windows. Prefix sums of the turns' tokens choose spans of whole turns; each
window holds the system turn, a limited history repeated from before its span, and the span. The loss mask covers the texts of
assistant turns in the span alone, so that a repeated turn is a target once.

Template: ``<s>`` and the turns. ``[SYS] t [/SYS]``, ``[INST] t [/INST]`` and ``[OUT] t </s>`` are the system's, the user's and the
assistant's turns, ``[TURN] role [TEXT] t [/TURN]`` any other's. Inside a text every backslash is doubled and every control
string gets a backslash after its first character, which can be undone exactly.

Turns are numbered by their rank in the conversation: ranks and sums of tokens within chunks of turn numbers first, then the offsets
of the chunks. Spans are chosen from these numbers alone, one row per conversation, and the texts are joined to them, so that
neither chunks nor gaps in the turn numbers show. Defined results: a NULL text is empty, a NULL role is the empty role; rows are
ordered by turn (NULL first), then role, then text, and repeated rows are turns of their own; a NULL conv_id is a conversation
like any other. A turn longer than the budget has a window of its own. Tokens are counted as stretches between white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window, turns and tokens of repeated history, turn numbers that are ranked together.
BUDGET, HISTORY_TURNS, HISTORY_TOKENS, CHUNK = 512, 2, 128, 128
#: Windows that are held together while a conversation is cut.
STRETCH = 128

# The control strings of the template.
HEADS = {"system": "[SYS] ", "user": "[INST] ", "assistant": "[OUT] "}
TAILS = {"system": " [/SYS]", "user": " [/INST]", "assistant": " </s>"}
OTHER_HEAD, OTHER_TEXT, OTHER_TAIL = "[TURN] ", " [TEXT] ", " [/TURN]"
_CONTROL = r"(<|\[)(/?(?:s>|SYS\]|INST\]|OUT\]|TURN\]|TEXT\]))"
_AFTER_TURN = r"(?<=\[/SYS\]|\[/INST\]|</s>|\[/TURN\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def _by_role(role: Column, values: dict[str, str], other: Column) -> Column:
    chosen = None
    for name, value in values.items():
        chosen = F.when(role == name, F.lit(value)) if chosen is None else chosen.when(role == name, F.lit(value))
    return chosen.otherwise(other)


def turns(rows: DataFrame) -> DataFrame:
    """Rows with their rank ``i`` from 1, rendered parts, tokens, and ``sums``, the tokens up to and with them."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    own = rows.select(
        "conv_id", F.floor(F.coalesce("turn", F.lit(-(1 << 62))) / CHUNK).alias("chunk"), "turn",
        role.alias("role"), text.alias("text")).withColumn("tokens", F.regexp_count("text", F.lit(r"\S+")) + 2)
    order = Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = own.withColumns({"rank": F.row_number().over(order), "sum": F.sum("tokens").over(upto)})
    # Numbers of whole chunks, without texts.
    before = Window.partitionBy("c").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.groupBy(F.col("conv_id").alias("c"), F.col("chunk").alias("k")).agg(
        F.count("*").alias("n"), F.sum("tokens").alias("t")).select(
        "c", "k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t"))
    placed = ranked.join(offsets, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
    return placed.select(
        "conv_id", (F.col("n") + F.col("rank")).cast("int").alias("i"), "role", "text", "tokens",
        (F.col("t") + F.col("sum")).alias("sums"),
        _by_role(F.col("role"), HEADS, F.concat(F.lit(OTHER_HEAD), escaped(F.col("role")), F.lit(OTHER_TEXT))).alias("head"),
        escaped(F.col("text")).alias("body"), _by_role(F.col("role"), TAILS, F.lit(OTHER_TAIL)).alias("tail"))


def windows(rows: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
            history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """(conv_id, window, formatted, new_at, loss): ``new_at`` is where the repeated part ends, ``loss`` the masked-in spans.

    Positions are code points from 0, ends exclusive.
    """
    numbered = turns(rows)
    grouped = numbered.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("i", "tokens", "sums"))).alias("all"),
        F.coalesce(F.min(F.when(F.col("role") == "system", F.col("i"))), F.lit(0)).alias("system"))
    fresh = f"""
        element_at(filter(transform(
          sequence(greatest(1, i - {history_turns}), i),
          h -> named_struct('start', i, 'since', h, 'used',
                 IF(system > 0 AND system < h, all[system - 1].tokens, 0) + all[i - 1].sums - all[h - 1].sums + all[h - 1].tokens)),
          w -> w.since = i OR (w.used <= {budget} AND all[i - 1].sums - all[i - 1].tokens
                                 - all[w.since - 1].sums + all[w.since - 1].tokens <= {history_tokens})), 1)"""
    span = "struct<start:int,since:int,used:bigint>"
    # The finished windows, in stretches so that a window of a long conversation does not copy all before it, and the open one.
    starts = F.expr(f"""
        aggregate(
          sequence(1, size(all)),
          cast(named_struct('done', array(), 'last', array(), 'open', null)
               as struct<done:array<array<{span}>>,last:array<{span}>,open:{span}>),
          (acc, i) -> CASE
            WHEN acc.open.used + all[i - 1].tokens <= {budget}
            THEN named_struct('done', acc.done, 'last', acc.last, 'open', cast(named_struct('start', acc.open.start, 'since', acc.open.since,
                                'used', acc.open.used + all[i - 1].tokens) as {span}))
            ELSE named_struct('done', IF(size(acc.last) < {STRETCH}, acc.done, concat(acc.done, array(acc.last))),
                              'last', concat(IF(size(acc.last) < {STRETCH}, acc.last, cast(array() as array<{span}>)),
                                             IF(acc.open IS NULL, cast(array() as array<{span}>), array(acc.open))),
                              'open', cast({fresh} as {span}))
          END,
          acc -> concat(flatten(acc.done), acc.last, array(acc.open)))""")
    spans = grouped.withColumn("starts", starts).select(
        F.col("conv_id").alias("c"), "system", F.size("all").alias("n"), "starts", F.posexplode("starts").alias("window", "w"))
    until = F.coalesce(F.get("starts", F.col("window") + 1)["start"], F.col("n") + 1)
    places = F.sequence(F.col("w.since"), until - 1)
    places = F.when((F.col("system") > 0) & (F.col("system") < F.col("w.since")), F.concat(F.array("system"), places)).otherwise(places)
    placed = spans.select("c", "window", F.col("w.start").alias("start"), F.explode(places).alias("place"))
    joined = numbered.join(placed, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("i") == F.col("place")))
    parts = joined.groupBy("conv_id", "window").agg(
        F.max("start").alias("start"), F.array_sort(F.collect_list(F.struct("i", "role", "head", "body", "tail"))).alias("all"))
    parts = parts.select(
        "conv_id", "window", F.expr("filter(all, t -> t.i >= start)").alias("new"),
        F.expr("filter(all, t -> t.i < start)").alias("repeated"))

    def whole(column: str) -> Column:
        return F.array_join(F.transform(column, lambda t: F.concat(t["head"], t["body"], t["tail"])), "")

    parts = parts.withColumn("before", F.concat(F.lit("<s>"), whole("repeated")))
    parts = parts.withColumn("new_at", F.length("before"))
    loss = F.expr("""
        aggregate(new, named_struct('at', new_at, 'spans', cast(array() as array<struct<start int, end int>>)),
          (acc, t) -> named_struct(
            'at', acc.at + length(t.head) + length(t.body) + length(t.tail),
            'spans', IF(t.role = 'assistant',
                concat(acc.spans, array(named_struct('start', acc.at + length(t.head),
                                                     'end', acc.at + length(t.head) + length(t.body)))),
                acc.spans)),
          acc -> acc.spans)""")
    return parts.select(
        "conv_id", "window", F.concat("before", whole("new")).alias("formatted"), "new_at", loss.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss_text): role and text of the span's turns, and the text under the mask, unescaped."""
    text = F.col("formatted").substr(F.col("new_at") + 1, F.length("formatted"))
    parts = F.filter(F.split(text, _AFTER_TURN), lambda t: t != "")

    def turn(t: Column) -> Column:
        known = [F.when(t.startswith(head), F.struct(
            F.lit(role).alias("role"),
            unescaped(t.substr(F.lit(len(head) + 1), F.length(t) - len(head) - len(TAILS[role]))).alias("text")))
            for role, head in HEADS.items()]
        inner = t.substr(F.lit(len(OTHER_HEAD) + 1), F.length(t) - len(OTHER_HEAD) - len(OTHER_TAIL))
        at = F.instr(inner, OTHER_TEXT)
        other = F.struct(unescaped(inner.substr(F.lit(1), at - 1)).alias("role"),
                         unescaped(inner.substr(at + len(OTHER_TEXT), F.length(inner))).alias("text"))
        return F.coalesce(*known, other)

    masked = F.transform("loss", lambda r: unescaped(F.col("formatted").substr(r["start"] + 1, r["end"] - r["start"])))
    return formatted.select(
        "conv_id", "window", F.transform(parts, turn).alias("turns"), F.array_join(masked, "").alias("loss_text"),
        F.length("formatted").alias("chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, all of it read back from the formatted windows."""
    pieces = read_back(formatted).select(
        "conv_id", "window", "chars", "loss_text", F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"))
    grouped = pieces.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "said", "loss_text"))).alias("w"))
    said = F.array_join(F.transform("w", lambda x: x["said"]), "")
    lost = F.array_join(F.transform("w", lambda x: x["loss_text"]), "")
    return grouped.select(
        "conv_id", "n_turns", F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"), F.sha2(lost.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


def sql(extra: str) -> str:
    """The digests in SQL over the table conversations and the rows ``extra``."""
    control = r"[<\[]/?(?:s>|SYS\]|INST\]|OUT\]|TURN\]|TEXT\])"

    def size(column: str) -> str:
        doubled = rf"replace({column}, '\', '\\')"
        return f"(length({doubled}) + len(regexp_extract_all({doubled}, '{control}')))"

    frame = " ".join(f"WHEN '{r}' THEN {len(HEADS[r]) + len(TAILS[r])}" for r in HEADS)
    other = len(OTHER_HEAD) + len(OTHER_TEXT) + len(OTHER_TAIL)
    return f"""
        WITH RECURSIVE c AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL {extra})),
        t AS (
          SELECT *, row_number() OVER w AS i, sum(tokens) OVER w AS sums, sum(size) OVER w AS sizes FROM (
            SELECT *, len(regexp_extract_all(text, '[^\\s\\x0B]+')) + 2 AS tokens,
              {size('text')} + CASE role {frame} ELSE {other} + {size('role')} END AS size FROM c)
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
        sys AS (SELECT DISTINCT ON (conv_id) conv_id, i, tokens, size FROM t WHERE role = 'system' ORDER BY conv_id, i),
        s AS (SELECT t.*, sys.i AS sys_i, sys.tokens AS sys_tokens, sys.size AS sys_size
              FROM t LEFT JOIN sys ON t.conv_id IS NOT DISTINCT FROM sys.conv_id),
        since AS (
          SELECT a.conv_id, a.i, min(b.i) AS since FROM s a JOIN s b
            ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i BETWEEN a.i - {HISTORY_TURNS} AND a.i
          WHERE b.i = a.i OR (CASE WHEN a.sys_i < b.i THEN a.sys_tokens ELSE 0 END + a.sums - b.sums + b.tokens <= {BUDGET}
                              AND a.sums - a.tokens - b.sums + b.tokens <= {HISTORY_TOKENS})
          GROUP BY ALL),
        fresh AS (
          SELECT a.*, since.since,
            CASE WHEN a.sys_i < since.since THEN a.sys_tokens ELSE 0 END + a.sums - b.sums + b.tokens AS used,
            3 + CASE WHEN a.sys_i < since.since THEN a.sys_size ELSE 0 END + a.sizes - a.size - b.sizes + b.size AS again
          FROM s a JOIN since ON a.conv_id IS NOT DISTINCT FROM since.conv_id AND a.i = since.i
          JOIN s b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = since.since),
        steps AS (
          SELECT conv_id, i, used, again FROM fresh WHERE i = 1
          UNION ALL
          SELECT f.conv_id, f.i,
            CASE WHEN p.used + f.tokens <= {BUDGET} THEN p.used + f.tokens ELSE f.used END,
            CASE WHEN p.used + f.tokens <= {BUDGET} THEN 0 ELSE f.again END
          FROM steps p JOIN fresh f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1),
        extra AS (SELECT conv_id, sum(again) AS again FROM steps GROUP BY conv_id)
        SELECT t.conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(sum(size) + any_value(again) AS BIGINT) AS formatted_chars
        FROM t JOIN extra ON t.conv_id IS NOT DISTINCT FROM extra.conv_id GROUP BY t.conv_id"""
