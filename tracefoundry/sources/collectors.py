"""Collectors of raw records: each is a scan that ends in the same schema."""

from __future__ import annotations

from abc import ABC, abstractmethod
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import parse_iso, record_id
from ..functions.trading import symbol_in
from ..operators.replies import threads
from ..schemas import RAW_RECORD

PLATFORMS = ("twitter", "telegram", "discord")


def raw_record(source: str, raw_text: Column, instrument: Column, timestamp_context: Column, metadata: Column | None = None) -> list[Column]:
    """Columns of a raw record; the id is a digest of the rest."""
    text = raw_text.cast("string")
    return [
        record_id(F.lit(source), instrument, timestamp_context, text).alias("id"),
        F.lit(source).alias("source"),
        instrument.cast("string").alias("instrument"),
        timestamp_context.cast("string").alias("timestamp_context"),
        text.alias("raw_text"),
        F.lit(None).cast("string").alias("decision_raw"),
        (F.create_map().cast("map<string,string>") if metadata is None else metadata).alias("metadata"),
    ]


class Collector(ABC):
    """A source of raw records.  It neither labels nor scores."""

    source_name = "unknown"

    @abstractmethod
    def collect(self, spark: SparkSession) -> DataFrame:
        """A frame with the columns of RAW_RECORD."""


class JournalCollector(Collector):
    """Markdown files; every ``#`` heading begins an entry."""

    source_name = "own_journal"

    def __init__(self, journal_dir: str):
        self.journal_dir = journal_dir

    def collect(self, spark: SparkSession) -> DataFrame:
        files = spark.read.text(self.journal_dir, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True)
        entries = files.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"(?m)^(?=# )")).alias("at", "entry")).where(F.trim("entry") != "")
        day = F.regexp_extract("entry", r"(\d{4}-\d{2}-\d{2}(?:T[\d:.]+(?:Z|[+-]\d{2}:\d{2})?)?)", 1)
        named = F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})", 1)
        when = F.coalesce(F.nullif(day, F.lit("")), F.nullif(named, F.lit("")))
        return entries.select(*raw_record(self.source_name, F.col("entry"), symbol_in(F.col("entry")), when, F.create_map(F.lit("path"), F.col("path"), F.lit("at"), F.col("at").cast("string"))))


class PostCollector(Collector):
    """Posts in JSON arrays, of chosen accounts on one platform."""

    source_name = "kol_post"

    def __init__(self, accounts: list[str], platform: str, path: str):
        if platform not in PLATFORMS:
            raise ValueError(f"platform has to be one of {PLATFORMS}")
        self.accounts, self.platform, self.path = accounts, platform, path

    def collect(self, spark: SparkSession) -> DataFrame:
        from .posts import read_posts

        posts = read_posts(spark, self.path)
        posts = posts.where(F.col("handle").isin(self.accounts)) if self.accounts else posts
        symbol = F.coalesce(F.col("trade.symbol"), symbol_in(F.col("text")))
        return posts.select(*raw_record(self.source_name, F.col("text"), symbol, F.col("timestamp"), F.create_map(F.lit("platform"), F.lit(self.platform), F.lit("handle"), F.col("handle"))))


def html_text(html: Column) -> Column:
    """Visible text of a page: no scripts, styles or tags; single spaces."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


class ResearchCollector(Collector):
    """HTML reports, one segment per heading."""

    source_name = "research_note"

    def __init__(self, pages: DataFrame | None = None, source_dir: str | None = None):
        self.pages, self.source_dir = pages, source_dir

    def collect(self, spark: SparkSession) -> DataFrame:
        if self.pages is None:
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", True).load(self.source_dir)
            pages = files.select(F.col("path").alias("url"), F.decode("content", "UTF-8").alias("html"), F.col("modificationTime").cast("string").alias("seen"))
        else:
            pages = self.pages.select("url", "html", F.lit(None).cast("string").alias("seen"))
        parts = pages.select("url", "seen", F.posexplode(F.split("html", r"(?i)(?=<h[1-6]\b)")).alias("at", "part"))
        text = html_text(F.col("part"))
        return parts.where(text != "").select(*raw_record(self.source_name, text, symbol_in(text), F.col("seen"), F.create_map(F.lit("url"), F.col("url"), F.lit("at"), F.col("at").cast("string"))))


class ChatLogCollector(Collector):
    """Conversations: the turns of each, in order, are one record."""

    source_name = "chat_log"

    def __init__(self, conversations: DataFrame, platform: str = "telegram"):
        if platform not in PLATFORMS[1:]:
            raise ValueError(f"platform has to be one of {PLATFORMS[1:]}")
        self.conversations, self.platform = conversations, platform

    def collect(self, spark: SparkSession) -> DataFrame:
        turn = F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))
        chains = self.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
        text = F.array_join(F.col("turns.line"), "\n")
        return chains.select(*raw_record(self.source_name, text, symbol_in(text), F.lit(None), F.create_map(F.lit("conv_id"), F.col("conv_id").cast("string"), F.lit("platform"), F.lit(self.platform))))


#: Fields of the two platforms' exports; numbers and texts as they come, a text may be an array of parts.
TELEGRAM = "messages array<struct<id: long, type: string, date: string, from: string, text: variant, reply_to_message_id: long>>"
DISCORD = "messages array<struct<id: string, timestamp: string, author: struct<name: string>, content: string, reference: struct<messageId: string>>>"


def _plain(text: Column) -> Column:
    """A message's text: itself, or its parts, each a text or an object with one."""
    parts = F.transform(F.try_variant_get(text, "$", "array<variant>"), lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")), F.lit("")))
    return F.when(F.schema_of_variant(text).startswith("ARRAY"), F.array_join(parts, "")).otherwise(F.try_variant_get(text, "$", "string"))


def read_chat_export(spark: SparkSession, path: str, platform: str) -> DataFrame:
    """(chat, id, reply_to, ts, author, text) of the messages in JSON exports; a file is a chat.  Service messages are left out."""
    if platform not in PLATFORMS[1:]:
        raise ValueError(f"platform has to be one of {PLATFORMS[1:]}")
    files = spark.read.schema(TELEGRAM if platform == "telegram" else DISCORD).json(path, multiLine=True, recursiveFileLookup=True)
    rows = files.select(F.col("_metadata.file_path").alias("chat"), F.explode("messages").alias("m"))
    if platform == "telegram":
        rows = rows.where("m.type = 'message'")
        return rows.select("chat", F.col("m.id").cast("string").alias("id"), F.col("m.reply_to_message_id").cast("string").alias("reply_to"), parse_iso(F.col("m.date")).alias("ts"), F.col("m.from").alias("author"), _plain(F.col("m.text")).alias("text"))
    return rows.select("chat", "m.id", F.col("m.reference.messageId").alias("reply_to"), parse_iso(F.col("m.timestamp")).alias("ts"), F.col("m.author.name").alias("author"), F.col("m.content").alias("text"))


class ReplyChainCollector(Collector):
    """Chat messages (chat, id, reply_to, ts, author, text): a thread of answers, in reading order, is one record.

    A line is indented by what it answers to.  The record has the first
    message's time and the first symbol named in the thread.
    """

    source_name = "chat_log"

    def __init__(self, messages: DataFrame | None = None, export_path: str | None = None, platform: str = "telegram"):
        if platform not in PLATFORMS[1:]:
            raise ValueError(f"platform has to be one of {PLATFORMS[1:]}")
        self.messages, self.export_path, self.platform = messages, export_path, platform

    def collect(self, spark: SparkSession) -> DataFrame:
        rows = read_chat_export(spark, self.export_path, self.platform) if self.messages is None else self.messages
        # ids are a chat's own
        named = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws("\x1f", "chat", F.col(c).cast("string")))
        rows = rows.select(named("id").alias("id"), named("reply_to").alias("reply_to"), "ts", "author", "text").where("id is not null")
        rows = rows.groupBy("id").agg(F.min_by(F.struct("reply_to", "ts", "author", "text"), F.struct("ts", "reply_to", "author", "text")).alias("m")).select("id", "m.*")
        met = rows.join(threads(rows), "id")
        line = F.concat(F.repeat(F.lit("  "), F.col("depth").cast("int")), F.concat_ws(": ", "author", "text"))
        chains = met.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"), F.min_by("ts", "place").alias("ts"), F.count("*").alias("n"))
        text = F.array_join(F.col("lines.line"), "\n")
        facts = F.create_map(F.lit("root"), F.substring_index("root", "\x1f", -1), F.lit("messages"), F.col("n").cast("string"), F.lit("platform"), F.lit(self.platform))
        return chains.select(*raw_record(self.source_name, text, symbol_in(text), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX"), facts))


class OnChainCollector(Collector):
    """Round trips as records without text; results are in the metadata."""

    source_name = "on_chain"

    def __init__(self, round_trips: DataFrame, wallets: list[str] | None = None):
        self.round_trips, self.wallets = round_trips, wallets

    def collect(self, spark: SparkSession) -> DataFrame:
        rows = self.round_trips
        if self.wallets and "wallet" in rows.columns:
            rows = rows.where(F.col("wallet").isin(self.wallets))
        facts = [x for n in ("direction", "exit_time", "realized_pnl_pct", "verdict") for x in (F.lit(n), F.col(n).cast("string"))]
        return rows.select(*raw_record(self.source_name, F.lit(""), F.col("symbol"), F.col("entry_time"), F.create_map(*facts)))


def run_collection(spark: SparkSession, collectors: list[Collector], output_dir: str) -> DataFrame:
    """Write all records as JSON, a folder per source; returns records per source."""
    if not collectors:
        raise ValueError("no collector is configured")
    records = reduce(DataFrame.unionByName, (c.collect(spark) for c in collectors))
    records.write.mode("overwrite").partitionBy("source").json(output_dir)
    schema = RAW_RECORD.replace("source string, ", "") + ", source string"
    return spark.read.schema(schema).json(output_dir).groupBy("source").agg(F.count("*").alias("records"))
