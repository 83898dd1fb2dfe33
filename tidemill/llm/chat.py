"""Chat formatting by quotation linking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import kept

MARKS = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"(?i)^(?:on\b.*\bwrote|.*\bwrote on\b.*|.*\bschrieb|.*\ba écrit|.*\bescribió)\s*:\s*$"


def parsed(messages: DataFrame, text: str = "text") -> DataFrame:
    """Adds `_lines`: per line its quote level, its body without marks, its normalised hash (null if blank) and whether it only announces a quote."""
    rows = F.split(F.coalesce(F.col(text), F.lit("")), "\r?\n")
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", ""))
    body = lambda x: F.regexp_replace(x, MARKS + r"[ \t]?", "")
    norm = lambda x: F.trim(F.regexp_replace(F.lower(body(x)), r"\s+", " "))
    lines = F.transform(rows, lambda x: F.struct(level(x).alias("level"), body(x).alias("body"), x.alias("raw"), F.when(norm(x) != "", F.md5(norm(x))).alias("hash")))
    out = messages.withColumn("_read", lines)
    announced = lambda x, i: x["body"].rlike(ATTRIBUTION) & (F.coalesce(F.get("_read", i + 1)["level"], F.lit(0)) > x["level"])
    return out.withColumn("_lines", F.transform("_read", lambda x, i: x.withField("announces", announced(x, i)))).drop("_read")


def quote_links(read: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, turn, reply_to, votes, linked): which earlier message a message quotes, and the hashes of all its quoted lines that were found.

    Each quoted line goes to the latest earlier message of the conversation
    that has it as its own line; the shallowest level decides, then the most
    lines, then the later message.  Quoted and own lines meet in one window
    per (conversation, line hash), so a line quoted and written often costs
    its number of rows, never their product.
    """
    keys = [F.col(conv).alias("conv"), F.col(turn).alias("turn")]
    lines = read.where(F.col(conv).isNotNull() & F.col(turn).isNotNull()).select(*keys, F.explode("_lines").alias("x"))
    lines = lines.where("x.hash IS NOT NULL AND NOT x.announces").select("conv", "turn", "x.level", "x.hash")
    quoted = lines.where("level > 0").groupBy("conv", "hash").agg(F.lit(1).alias("n")).select("conv", "hash")
    met = lines.join(quoted, ["conv", "hash"], "left_semi")
    before = Window.partitionBy("conv", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = met.withColumn("origin", F.max(F.when(F.col("level") == 0, F.col("turn"))).over(before)).where("level > 0 AND origin IS NOT NULL")
    votes = found.groupBy("conv", "turn", "level", "origin").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "votes", "origin")).alias("b"))
    # As many as the message has lines.
    known = found.groupBy("conv", "turn").agg(F.collect_set("hash").alias("linked"))
    return best.join(known, ["conv", "turn"]).select("conv", "turn", F.col("b.origin").alias("reply_to"), F.col("b.votes").alias("votes"), "linked")


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, votes, thread, depth): root and distance of every linked message, by pointer doubling."""
    at = kept(links.select("*", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "threads")
    while True:
        above = at.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("_top"), F.col("depth").alias("_more"))
        joined = at.join(above, ["conv", "thread"], "left")
        step = joined.select("conv", "turn", "reply_to", "votes", F.coalesce("_top", "thread").alias("thread"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.col("_top").isNotNull().alias("_moved"))
        step = kept(step, "threads")
        if not step.where("_moved").limit(1).count():
            return step.drop("_moved")
        at = step.drop("_moved")


def format_chats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message, in reply order: conv_id, thread, turn, role, reply_to, depth, quoted_lines, linked_lines, max_level, content, chat.

    `content` is the message without the quoted lines found in an earlier
    message, blank quoted lines between, and the lines that announce them;
    quotes from elsewhere stay as they are, with their marks, or their text
    would be lost.  `chat` is the same as a chat turn.  A message that quotes
    nothing known starts a thread; the order is conversation, thread, turn, so
    replies follow the message they answer.  Conversations stay rows, since
    one of them may hold a third of the table; the sort is by ranges of
    (conversation, thread, turn) and splits it.

    Null text is empty, a null role is 'unknown'.  Rows with a null
    conversation or turn are formatted but linked with nothing.  Repeated rows
    are repeated in the result.  Other columns are ignored, whatever their
    names; an empty table gives an empty result.
    """
    cols = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    read = parsed(cols, "text")
    found = quote_links(read, "conv", "turn")
    links = threads(found.drop("linked")).join(found.select("conv", "turn", "linked"), ["conv", "turn"])
    known = F.coalesce("linked", F.array().cast("array<string>"))
    gone = lambda x: F.when(x["level"] > 0, x["hash"].isNull() | F.array_contains("_known", x["hash"])).otherwise(x["announces"])
    quotes = F.size("_known") > 0
    own = F.filter("_lines", lambda x: ~F.coalesce(quotes & gone(x), F.lit(False)))
    content = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["raw"]), "\n"), r"^\s+|\s+$", "")
    quoted = F.size(F.filter("_lines", lambda x: x["level"] > 0))
    deepest = F.coalesce(F.array_max(F.transform("_lines", lambda x: x["level"])), F.lit(0))
    out = read.join(links, ["conv", "turn"], "left").withColumn("_known", known).select(
        F.col("conv").alias("conv_id"),
        F.coalesce("thread", "turn").alias("thread"),
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        "reply_to",
        F.coalesce("depth", F.lit(0)).alias("depth"),
        quoted.alias("quoted_lines"),
        F.coalesce("votes", F.lit(0)).alias("linked_lines"),
        deepest.alias("max_level"),
        content.alias("content"),
    )
    return out.withColumn("chat", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "content", F.lit("\n<|end|>\n"))).orderBy("conv_id", "thread", "turn")
