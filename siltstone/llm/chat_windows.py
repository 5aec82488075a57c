"""Chat formatting into budgeted windows, in DataFrame operations.

Prefix sums of turn tokens choose each window's turns: those whose first token falls into
the same slot of the conversation. A later window begins with the conversation's system
turn and with the last turns before it that fit a history budget; both are masked, so
every assistant text is trained on once.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a backslash
becomes two, and one is set into each control string after its first character (in
roles also before a line break); taking the backslashes out again gives the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.scratch import Scratch

# The template's marks and the control strings that are escaped in texts.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]")


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chat_windows(
    turns: DataFrame, *, budget: int = 1024, history: int = 256, characters: int = 4
) -> DataFrame:
    """Windows of every conversation of ``turns`` (conv_id, turn, role, text).

    Returns conv_id, window (from 0), text, spans (array of start and stop: code points of
    ``text`` under the loss mask), repeated (leading turns that an earlier window has) and
    tokens. A turn counts one token for each ``characters`` of its formatted length, rounded up. Turns are never
    cut: one longer than half of what system turn and history leave of the budget has a
    window of its own, with its system turn and history, and may exceed the budget; no
    other window does, unless the system turn takes more than half of it. Turns go by turn
    number (null first), role and text; repeated turns stay. Null roles and texts count
    as empty; a null conv_id is one conversation. An empty table gives no windows.
    """
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\\n"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    body = escaped(F.coalesce("text", F.lit("")))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), head.alias("head"), body.alias("body")
    ).withColumn("chars", F.length("head") + F.length("body") + len(CLOSE))
    rows = rows.withColumn("tokens", F.ceil(F.col("chars") / characters))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = rows.withColumn("place", F.row_number().over(ordered)).withColumns({
        "is_system": (F.col("place") == 1) & (F.col("role") == "system"),
    })
    by_place = Window.partitionBy("conv_id").orderBy("place")
    first = F.first(F.when(F.col("is_system"), F.struct("head", "body", "chars", "tokens"))).over(by_place)
    rows = rows.withColumn("system", first)
    room = F.greatest(F.lit(budget // 4), F.floor((F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0))) / 2))
    earlier = F.sum(F.when(~F.col("is_system"), F.col("tokens"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"before": F.coalesce(earlier, F.lit(0)), "room": room})
    rows = rows.withColumns({
        "slot": F.floor(F.col("before") / F.col("room")),
        "long": ~F.col("is_system") & (F.col("tokens") > F.col("room")),
    })
    last = F.lag(F.struct("slot", "long", "is_system")).over(by_place)
    opens = last.isNotNull() & ~last["is_system"] & (
        (last["slot"] != F.col("slot")) | F.col("long") | last["long"]
    )
    # Counted again by place: Spark keeps one sort for all windows of this conversation.
    rows = rows.withColumn("opens", F.coalesce(opens, F.lit(False)))
    rows = rows.withColumn("window", F.sum(F.col("opens").cast("int")).over(by_place))
    own = rows.select("conv_id", "window", "place", "role", "head", "body", "chars", "tokens", F.lit(True).alias("new"))
    later = rows.where("opens").select(
        F.col("conv_id").alias("to_conv"), F.col("window").alias("to"), F.col("before").alias("at"), "system"
    )
    systems = later.where("system is not null").select(
        F.col("to_conv").alias("conv_id"), F.col("to").alias("window"), F.lit(1).alias("place"),
        F.lit("system").alias("role"), "system.*", F.lit(False).alias("new"),
    )
    # A window that begins at token t repeats the turns that begin in [t - history, t):
    # both are dealt by ranges of history tokens, a turn into its own range and the next.
    near = rows.where(f"not is_system and tokens <= {history}").withColumn(
        "range", F.explode(F.array(F.floor(F.col("before") / history), F.floor(F.col("before") / history) + 1))
    )
    repeats = near.join(
        later.drop("system").withColumn("to_range", F.floor(F.col("at") / history)),
        F.col("conv_id").eqNullSafe(F.col("to_conv")) & (F.col("range") == F.col("to_range"))
        & (F.col("before") < F.col("at")) & (F.col("at") - F.col("before") <= history) & (F.col("window") < F.col("to")),
    ).select("conv_id", F.col("to").alias("window"), "place", "role", "head", "body", "chars", "tokens", F.lit(False).alias("new"))
    every = own.unionByName(systems).unionByName(repeats)
    inside = Window.partitionBy("conv_id", "window").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("chars").over(inside), F.lit(0)) + F.length("head")
    span = F.when(F.col("new") & (F.col("role") == "assistant"), F.struct(
        F.col("start").cast("int").alias("start"), (F.col("start") + F.length("body")).cast("int").alias("stop")
    ))
    parts = every.withColumn("start", start).withColumns({
        "span": span, "text": F.concat("head", "body", F.lit(CLOSE)),
    })
    grouped = parts.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("place", "text"))).alias("texts"),
        F.sort_array(F.collect_list("span")).alias("spans"),
        F.sum(F.when(F.col("new"), 0).otherwise(1)).cast("int").alias("repeated"),
        F.sum("tokens").alias("tokens"),
    )
    return grouped.select(
        "conv_id", F.col("window").cast("int").alias("window"), F.array_join("texts.text", "").alias("text"),
        "spans", "repeated", "tokens",
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Each window's new turns (role and text as they were) and its text under the loss mask."""
    turns = F.slice(
        F.split("text", r"<\|im_end\|>\n"), F.col("repeated") + 1,
        F.size(F.split("text", r"<\|im_end\|>\n")) - 1 - F.col("repeated"),
    )
    inner = F.transform(turns, lambda t: F.substr(t, F.lit(len(OPEN) + 1)))
    split = F.transform(inner, lambda t: F.struct(F.regexp_extract(t, r"^((?:[^\\\n]|\\[\s\S])*+)\n", 1).alias("role"), t.alias("t")))
    plain = F.transform(split, lambda t: F.struct(
        unescaped(t["role"]).alias("role"), unescaped(F.substr(t["t"], F.length(t["role"]) + 2)).alias("text")
    ))
    loss = F.transform("spans", lambda s: unescaped(F.substr("text", s["start"] + 1, s["stop"] - s["start"])))
    return windows.select(
        "conv_id", "window", plain.alias("turns"), F.array_join(loss, "").alias("loss"), F.length("text").alias("chars")
    )


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation: turns, digest of all turns, characters and digest of the loss text, formatted characters.

    A digest needs its conversation's whole text in one row; there is no other way to
    compute SHA-256 over it.
    """
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read_windows(windows).withColumns({"said": text, "count": F.size("turns")})
    whole = parts.groupBy("conv_id").agg(
        F.sum("count").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("parts"),
    ).withColumns({"said": F.array_join("parts.said", ""), "loss": F.array_join("parts.loss", "")})
    return whole.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def chat_digests(turns: DataFrame) -> DataFrame:
    """``digests`` of the windows of ``turns``, which are written and read back."""
    return digests(Scratch(turns.sparkSession).keep(chat_windows(turns), "windows"))


CHAT_SQL = r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, replace(replace(replace(replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '</s>', '<\/s>'),
            '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS body FROM raw),
sized AS (
  SELECT *, length(role) + length(body) + 24 AS chars, ceil((length(role) + length(body) + 24) / 4)::BIGINT AS tokens,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS place FROM escaped),
marked AS (SELECT *, place = 1 AND role = 'system' AS is_system FROM sized),
systems AS (SELECT conv_id, chars AS system_chars, tokens AS system_tokens FROM marked WHERE is_system),
summed AS (
  SELECT m.*, system_chars,
         greatest(256, floor((1024 - 256 - coalesce(system_tokens, 0)) / 2)) AS room,
         coalesce(sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER (
           PARTITION BY m.conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM marked m LEFT JOIN systems s ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
slotted AS (SELECT *, floor(before / room) AS slot, NOT is_system AND tokens > room AS long FROM summed),
opened AS (
  SELECT *, coalesce(NOT lag(is_system) OVER w AND (lag(slot) OVER w <> slot OR long OR lag(long) OVER w), false) AS opens
  FROM slotted WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
windowed AS (SELECT *, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY place) AS win FROM opened),
repeats AS (
  SELECT o.conv_id, coalesce(sum(o.system_chars), 0) AS system_chars FROM windowed o WHERE opens GROUP BY o.conv_id),
history AS (
  SELECT o.conv_id, sum(n.chars) AS history_chars
  FROM windowed o JOIN windowed n ON o.conv_id IS NOT DISTINCT FROM n.conv_id AND o.opens AND NOT n.is_system
   AND n.tokens <= 256 AND n.before < o.before AND o.before - n.before <= 256 AND n.win < o.win
  GROUP BY o.conv_id),
whole AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sum(chars) AS chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY place), '') AS loss
  FROM windowed GROUP BY conv_id)
SELECT w.conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       (chars + coalesce(system_chars, 0) + coalesce(history_chars, 0))::BIGINT AS formatted_chars
FROM whole w LEFT JOIN repeats r ON w.conv_id IS NOT DISTINCT FROM r.conv_id
LEFT JOIN history h ON w.conv_id IS NOT DISTINCT FROM h.conv_id
"""
