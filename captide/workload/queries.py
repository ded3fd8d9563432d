"""Registered queries: each builds its input from whole tables and runs one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captide.editions import edition
from captide.functions import captions, identifiers, tags, text
from captide.operators import catalogue, commercials, ordering, release, shows
from captide.plans import corpus as plan
from captide.session import shared_folder, spread, staged, tune
from captide.sinks import corpus as sink
from captide.sinks.documents import write_documents
from captide.sources import archives, documents, gzip_members, split_csv
from captide.sources import commercials as commercial_source
from captide.sources import corpus as corpus_source
from captide.sources import identifiers as identifier_source
from captide.streaming.ingest import ingest, raw_stream
from captide.workload import inputs
from captide.workload.inputs import table

QUERIES = {}
ARCHIVE_BYTES = 16 * 1024 * 1024


def query(function):
    """Register a query under its name, with the session tuned for caption data."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# --- sources ---------------------------------------------------------------


def _customer_list(spark, sf_dir):
    path = shared_folder(spark, "identifiers")
    names = table(spark, sf_dir, "customer").orderBy("c_custkey").select(F.col("c_name").alias("identifier"))
    names.write.option("header", True).option("quoteAll", True).csv(path)
    return identifier_source.read_identifiers(spark, path)


@query
def identifier_scan(spark, sf_dir):
    return _customer_list(spark, sf_dir)


@query
def identifier_skip(spark, sf_dir):
    return identifier_source.skip_identifiers(_customer_list(spark, sf_dir), 25)


@query
def document_scan_prefer_plain(spark, sf_dir):
    folder = shared_folder(spark, "documents")
    supplier = table(spark, sf_dir, "supplier").withColumn("identifier", F.replace("s_name", F.lit("#"), F.lit("_")))
    name = F.col("identifier")

    def document(form):
        body = F.concat(F.lit("<metadata>"), inputs.element("title", name), inputs.element("form", form), F.lit("</metadata>"))
        return supplier.select("identifier", "s_acctbal", body.cast("binary").alias("content"))

    plain_name = F.concat(name, F.lit(identifiers.META_SUFFIX))
    write_documents(document("compressed"), folder, F.concat(plain_name, F.lit(identifiers.GZIP_SUFFIX)), compressed=True)
    write_documents(document("plain").filter("s_acctbal >= 3000"), folder, plain_name)
    parsed = shows.tag_documents(documents.read_documents(spark, folder, "meta"))
    return shows.widen(shows.good_tags(parsed), ["title", "form"], "identifier")


@query
def commercial_json_scan(spark, sf_dir):
    path = shared_folder(spark, "commercials")
    records = inputs.commercial_records(spark, sf_dir)
    records.select("archive_id", "intervals").write.json(path)
    scanned = commercial_source.read_commercials(spark, path)
    rows = scanned.select("archive_id", F.posexplode("intervals").alias("n", "pair"))
    return rows.select(
        "archive_id", F.col("n").cast("bigint").alias("n"), F.get("pair", F.lit(0)).alias("low"), F.get("pair", F.lit(1)).alias("high")
    )


@query
def commercial_json_array(spark, sf_dir):
    """The records as files that hold one JSON array each."""
    path = shared_folder(spark, "commercial-arrays")
    records = inputs.commercial_records(spark, sf_dir)
    line = F.to_json(F.struct("archive_id", "intervals"))
    part = F.pmod(F.xxhash64("archive_id"), F.lit(8)).alias("part")
    arrays = records.groupBy(part).agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(line), ",\n"), F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("part").text(path)
    scanned = commercial_source.read_commercials(spark, f"{path}/part=*", lines=False)
    rows = scanned.select("archive_id", F.posexplode("intervals").alias("n", "pair"))
    return rows.select(
        "archive_id", F.col("n").cast("bigint").alias("n"), F.get("pair", F.lit(0)).alias("low"), F.get("pair", F.lit(1)).alias("high")
    )


@query
def caption_encodings(spark, sf_dir):
    """Page texts under four declarations of their charset, or under none that counts."""
    text = F.concat(F.lit("é ü ñ "), F.col("n_chars").cast("string"))
    filler = F.lit("<!-- " + "x" * 5000 + " -->")
    kind = F.pmod("doc_id", F.lit(4))
    latin = lambda head: F.encode(F.concat(head, F.lit("<body><div class='snipin nosel'>"), text, F.lit("</div></body></html>")), "ISO-8859-1")
    utf8 = lambda head: F.encode(F.concat(head, F.lit("<body><div class='snipin nosel'>"), text, F.lit("</div></body></html>")), "UTF-8")
    content = (
        F.when(kind == 0, latin(F.lit("<html><head><meta charset='iso-8859-1'></head>")))
        .when(kind == 1, latin(F.concat(F.lit("<html><head>"), filler, F.lit("<meta charset='iso-8859-1'></head>"))))
        .when(kind == 2, latin(F.lit("<?xml version='1.0' encoding='iso-8859-1'?><html><head></head>")))
        .otherwise(utf8(F.lit("<html><head><script charset='iso-8859-1'></script><meta charset='utf-8'></head>")))
    )
    shown = inputs.shows(spark, sf_dir).select("identifier", content.alias("content"))
    return shows.caption_texts(shown).select("identifier", "text")


@query
def corpus_csv_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "corpus")
    sink.write_corpus(inputs.shows(spark, sf_dir).select("identifier", "lang", "text"), path, max_rows=5000)
    return corpus_source.read_corpus(spark, path, ["identifier", "lang", "text"])


@query
def corpus_csv_split(spark, sf_dir):
    """The corpus written as plain CSV and read back by byte ranges of 64 KB, many to a file."""
    path = shared_folder(spark, "corpus-plain")
    sink.write_corpus(inputs.shows(spark, sf_dir).select("identifier", "lang", "text"), path, compression="none")
    return split_csv.read_split_csv(spark, path, ["identifier", "lang", "text"], range_bytes=64 * 1024)


@query
def corpus_gzip_members(spark, sf_dir):
    """The corpus appended to gzip files batch by batch, and read back one task a member."""
    path = shared_folder(spark, "corpus-members")
    columns = ["identifier", "lang", "text"]
    gzip_members.write_gzip_members(inputs.shows(spark, sf_dir), path, columns).collect()
    return gzip_members.read_gzip_csv(spark, path, columns, range_bytes=1 << 20)


@query
def preview_projection(spark, sf_dir):
    return ordering.preview(inputs.shows(spark, sf_dir), 120, ["identifier", "text"], "doc_id")


@query
def positional_look(spark, sf_dir):
    return ordering.row_at(inputs.shows(spark, sf_dir), 1, ["identifier", "text"], "doc_id")


@query
def archive_listing_ids(spark, sf_dir):
    path = shared_folder(spark, "listing")
    suffix = F.when(F.col("lang") == "en", ".html").otherwise(".jpg")
    line = F.concat(
        F.lit("-rw-r--r-- tv/tv "), F.col("n_chars").cast("string"), F.lit(" 2022-05-01 10:00 html/"), "identifier", suffix
    )
    inputs.shows(spark, sf_dir).select(line.alias("value")).write.text(path)
    return identifier_source.read_archive_listing(spark, path, edition("2022"))


def _archived_pages(spark, sf_dir, settings, mode, suffix):
    folder = shared_folder(spark, "archives")
    member = identifiers.member_name(F.col("identifier"), settings)
    members = inputs.shows(spark, sf_dir).select(member.alias("name"), F.col("text").cast("binary").alias("content"))
    size = members.agg(F.sum(F.octet_length("content").cast("bigint"))).first()[0] or 0
    inputs.write_archives(members.repartition(4 + size // ARCHIVE_BYTES), folder, mode, suffix)
    return archives.list_archives(spark, folder)


@query
def archive_member_extract(spark, sf_dir):
    settings = edition("2022")
    listed = _archived_pages(spark, sf_dir, settings, "w|gz", ".tar.gz")
    wanted = inputs.commercial_records(spark, sf_dir).select("archive_id")
    pages = archives.read_members(listed, settings, wanted)
    return pages.select("archive_id", F.col("content").cast("string").alias("content"))


@query
def archive_member_ranges(spark, sf_dir):
    settings = edition("2023")
    listed = _archived_pages(spark, sf_dir, settings, "w|", ".tar")
    wanted = inputs.commercial_records(spark, sf_dir).select("archive_id")
    pages = archives.read_plain_members(listed, settings, wanted)
    return pages.select("archive_id", F.col("content").cast("string").alias("content"))


# --- metadata documents and the wide table -----------------------------------


def _tagged(spark, sf_dir):
    return shows.tag_documents(inputs.meta_documents(spark, sf_dir))


@query
def xml_tag_map(spark, sf_dir):
    tagged = shows.good_tags(_tagged(spark, sf_dir))
    values = tagged.select("identifier", F.explode("tags").alias("tag", "values"))
    return values.select("identifier", "tag", F.posexplode("values").alias("n", "value")).withColumn("n", F.col("n").cast("bigint"))


@query
def xml_tag_map_compat(spark, sf_dir):
    parsed = shows.tag_documents(inputs.meta_documents(spark, sf_dir), compat=True)
    return shows.widen(shows.good_tags(parsed), ["description", "title"], "identifier")


@query
def tag_fold(spark, sf_dir):
    folded = shows.good_tags(_tagged(spark, sf_dir)).select("identifier", tags.fold_tags(F.col("tags")).alias("tags"))
    return folded.select("identifier", F.explode("tags").alias("tag", "folded"))


@query
def tag_inventory(spark, sf_dir):
    return shows.tag_inventory(shows.good_tags(_tagged(spark, sf_dir)))


@query
def xml_quarantine(spark, sf_dir):
    parsed = shows.tag_documents(inputs.faulty_meta_documents(spark, sf_dir))
    reason = F.regexp_extract("error", "mismatched tag", 0).alias("reason")
    return shows.tag_quarantine(parsed).select("identifier", "stage", reason)


@query
def xml_truncated(spark, sf_dir):
    parsed = shows.tag_documents(inputs.faulty_meta_documents(spark, sf_dir)).filter("truncated")
    return shows.widen(parsed, ["collection", "title"], "identifier")


def _wide(spark, sf_dir):
    meta = inputs.meta_documents(spark, sf_dir).filter("lang <> 'es'").select("identifier", "content")
    pages = inputs.shows(spark, sf_dir).filter("lang <> 'de'").select("identifier", inputs.page(F.col("text")).alias("content"))
    wide, _ = plan.parse_shows(inputs.listed_shows(spark, sf_dir), meta, pages, shared_folder(spark, "shows"))
    return wide


@query
def wide_table(spark, sf_dir):
    return _wide(spark, sf_dir)


@query
def show_assembly(spark, sf_dir):
    meta = inputs.meta_documents(spark, sf_dir).filter("lang <> 'es'").select("identifier", "content")
    pages = inputs.shows(spark, sf_dir).filter("lang <> 'de'").select("identifier", inputs.page(F.col("text")).alias("content"))
    tagged = shows.good_tags(shows.tag_documents(meta))
    assembled = shows.assemble_shows(inputs.listed_shows(spark, sf_dir), tagged, shows.caption_texts(pages))
    return shows.widen(assembled, ["collection"], "identifier", "text")


@query
def append_schema_merge(spark, sf_dir):
    path = shared_folder(spark, "appended")
    parsed = inputs.labelled_or_not(spark, sf_dir)
    old = parsed.filter("quality IS NULL").select("identifier", F.col("lang").alias("language"), "text")
    new = parsed.filter("quality IS NOT NULL").select("identifier", F.col("quality").cast("string").alias("thumbs"), "text")
    sink.append_shows(old, path)
    columns = sink.append_shows(new, path)
    return sink.read_shows(spark, path, columns)


# --- captions ------------------------------------------------------------------


@query
def full_text(spark, sf_dir):
    captioned = inputs.caption_pages(spark, sf_dir).withColumnRenamed("archive_id", "identifier")
    others = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("PAGE_"), F.col("page_id").cast("string")).alias("identifier"), F.col("html").cast("binary").alias("content")
    )
    return shows.caption_texts(captioned.unionByName(others)).select("identifier", "text")


@query
def timed_segments(spark, sf_dir):
    turn = F.col("turn").cast("int")
    body = inputs.container(F.col("text"), turn)
    pages = table(spark, sf_dir, "conversations").select("conv_id", "turn", body.cast("binary").alias("content"))
    segments = commercials.segment_pages(pages, edition("2022"))
    return segments.select("conv_id", "turn", F.inline("segments")).withColumn("pos", F.col("pos").cast("bigint"))


@query
def link_times(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    link = F.concat(F.lit("/start/"), F.col("o_custkey"), F.lit("/end/"), F.col("o_orderkey"), F.lit("/x"))
    current = F.concat(F.when(F.col("o_orderstatus") == "F", "x").otherwise(""), link)
    older = F.concat(F.lit("page#start/1/end/2#"), F.substring(link, F.lit(2), F.length(link)))
    start_now, end_now = captions.link_times(current, edition("2017"))
    start_2014, end_2014 = captions.link_times(older, edition("2014"))
    return orders.select(
        "o_orderkey",
        start_now.alias("start_now"),
        end_now.alias("end_now"),
        start_2014.alias("start_2014"),
        end_2014.alias("end_2014"),
    )


# --- commercials -----------------------------------------------------------------


@query
def commercial_cut(spark, sf_dir):
    pages, records = inputs.caption_pages(spark, sf_dir), inputs.commercial_records(spark, sf_dir)
    return commercials.cut_commercials(pages, records, edition("2022"))


@query
def commercial_cut_exploded(spark, sf_dir):
    pages = inputs.caption_pages(spark, sf_dir)
    records = commercials.first_records(inputs.commercial_records(spark, sf_dir))
    with_record = commercials.shows_with_records(pages, records)
    segments = commercials.segment_pages(with_record, edition("2022")).select("archive_id", F.inline("segments"))
    pairs = records.select("archive_id", F.explode("intervals").alias("pair"))
    intervals = pairs.select("archive_id", F.get("pair", F.lit(0)).alias("low"), F.get("pair", F.lit(1)).alias("high"))
    kept = commercials.keep_segment_rows(segments, intervals)
    return kept.select("archive_id", F.col("pos").cast("bigint").alias("pos"), "text")


@query
def commercial_cut_sweep(spark, sf_dir):
    """As ``commercial_cut_exploded``, with the cut by a sweep over sorted bounds."""
    pages = inputs.caption_pages(spark, sf_dir)
    records = commercials.first_records(inputs.commercial_records(spark, sf_dir))
    with_record = commercials.shows_with_records(pages, records)
    segments = commercials.segment_pages(with_record, edition("2022")).select("archive_id", F.inline("segments"))
    pairs = records.select("archive_id", F.explode("intervals").alias("pair"))
    intervals = pairs.select("archive_id", F.get("pair", F.lit(0)).alias("low"), F.get("pair", F.lit(1)).alias("high"))
    kept = commercials.keep_segment_rows_by_sweep(segments, intervals)
    return kept.select("archive_id", F.col("pos").cast("bigint").alias("pos"), "text")


@query
def segment_quarantine(spark, sf_dir):
    pages, records = inputs.faulty_caption_pages(spark, sf_dir), inputs.commercial_records(spark, sf_dir)
    return commercials.faulty_pages(pages, records, edition("2022"))


@query
def semi_commercial(spark, sf_dir):
    listing = inputs.shows(spark, sf_dir).filter("lang <> 'en'").select(F.col("identifier").alias("archive_id"))
    records = commercials.records_in_edition(inputs.commercial_records(spark, sf_dir), listing)
    return records.select("archive_id", F.col("pos").cast("bigint").alias("pos"), F.size("intervals").cast("bigint").alias("n_intervals"))


@query
def first_interval_record(spark, sf_dir):
    pair = F.array(F.col("value"), F.col("value") + 30)
    records = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("archive_id"), F.array(pair).alias("intervals"), F.col("event_id").alias("pos")
    )
    first = F.get("intervals", F.lit(0))
    return commercials.first_records(records).select(
        "archive_id", F.get(first, F.lit(0)).alias("low"), F.get(first, F.lit(1)).alias("high")
    )


# --- release -----------------------------------------------------------------------


def _release(spark, sf_dir):
    pages, records = inputs.caption_pages(spark, sf_dir), inputs.commercial_records(spark, sf_dir)
    cleaned = staged(commercials.cut_commercials(pages, records, edition("2022")), "cleaned")
    return release.merge_cleaned(inputs.shows(spark, sf_dir).select("identifier", "text"), cleaned)


@query
def merge_nc(spark, sf_dir):
    return _release(spark, sf_dir)


@query
def release_edition_2023(spark, sf_dir):
    """Stage 4 as a whole: the corpus as CSV with byte literals, stripped, with the cut texts and the edition."""
    path = shared_folder(spark, "corpus-2023")
    literal = F.concat(F.lit("b'"), F.replace("text", F.lit("\n"), F.lit("\\n")), F.lit("'"))
    sink.write_corpus(inputs.shows(spark, sf_dir).select("identifier", literal.alias("text")), path, max_rows=5000)
    corpus = staged(corpus_source.read_corpus(spark, path, ["identifier", "text"]), "corpus-2023")
    cleaned = _release(spark, sf_dir).where("text_nc IS NOT NULL").select(F.col("identifier").alias("archive_id"), "text_nc")
    return plan.release_edition(corpus, cleaned, edition("2023"))


@query
def nc_coverage(spark, sf_dir):
    return release.cleaned_rows(_release(spark, sf_dir), "text", "text_nc")


@query
def repr_strip(spark, sf_dir):
    # The percent code of a text, with its signs exchanged, is a bytes literal.
    coded = F.regexp_replace(F.replace(F.url_encode("text"), F.lit("+"), F.lit(" ")), "%([0-9A-F]{2})", r"\\x$1")
    literal = F.concat(F.lit("b'"), coded, F.lit("'"))
    values = spread(inputs.shows(spark, sf_dir)).select("identifier", literal.alias("literal"), "text")
    return values.select("identifier", text.strip_repr(F.col("literal")).alias("stripped"), text.strip_repr(F.col("text")).alias("plain"))


@query
def repr_strip_compat(spark, sf_dir):
    literal = F.concat(F.lit("b'"), F.replace("text", F.lit("\n"), F.lit("\\n")), F.lit("'"))
    return inputs.shows(spark, sf_dir).select(
        "identifier",
        text.strip_repr_compat(literal, edition("2023").repr_pattern).alias("stripped_2023"),
        text.strip_repr_compat(literal, edition("2022").repr_pattern).alias("stripped_2022"),
    )


@query
def release_manifest(spark, sf_dir):
    path = shared_folder(spark, "release")
    corpus = inputs.shows(spark, sf_dir).select(F.col("lang").alias("edition"), "identifier", "text")
    sink.write_release(corpus, path, max_rows=200)
    manifest = sink.release_manifest(spark.read.parquet(path))
    return manifest.groupBy("edition").agg(
        F.sum("rows").alias("rows"),
        F.min(F.col("rows") <= 200).alias("bounded"),
        F.min(F.col("bytes") > 0).alias("sized"),
    )


@query
def release_shard_bytes(spark, sf_dir):
    """The corpus released in shards of at most 64 KB of rows, or one larger row, checked from the files read back."""
    bound = 64 * 1024
    path = shared_folder(spark, "release-bytes")
    corpus = inputs.shows(spark, sf_dir).select(F.col("lang").alias("edition"), "identifier", "text")
    sink.write_release_by_bytes(corpus, path, bound, "identifier", oversized="alone")
    back = spark.read.parquet(path).withColumn("edition", F.col("edition").cast("string"))
    size = F.octet_length(F.to_json(F.struct("edition", "identifier", "text")))
    shards = back.groupBy("edition", "shard").agg(
        F.count("*").alias("rows"), F.sum(size).alias("bytes"), F.min("identifier").alias("first"), F.max("identifier").alias("last")
    )
    following = F.lead("first").over(Window.partitionBy("edition").orderBy("shard"))
    checked = shards.withColumn("in_order", F.coalesce(F.col("last") <= following, F.lit(True)))
    bounded = (F.col("bytes") <= bound) | (F.col("rows") == 1)
    return checked.groupBy("edition").agg(
        F.sum("rows").alias("rows"), F.min(bounded).alias("bounded"), F.min("in_order").alias("ordered")
    )


# --- catalogue ---------------------------------------------------------------------


@query
def catalogue_search(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "P", "tvnews").otherwise("tvarchive")
    catalogued = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ORDER_"), F.col("o_orderkey").cast("string")).alias("identifier"),
        F.array("o_orderpriority", kind).alias("collection"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    return catalogue.search_catalogue(catalogued, "1998-01-01", 5000)


@query
def valid_date_flag(spark, sf_dir):
    def digits(column):
        return F.col(column).cast("string")

    date = F.concat_ws("-", (F.year("o_orderdate") - 1996).cast("string"), digits("o_custkey"), digits("o_orderkey"), F.lit("x"))
    return table(spark, sf_dir, "orders").select("o_orderkey", identifiers.is_valid_date(date).alias("valid"))


@query
def source_urls(spark, sf_dir):
    columns = identifiers.source_columns(F.col("identifier"), compressed=True)
    return inputs.shows(spark, sf_dir).select("identifier", *[column.alias(name) for name, column in columns.items()])


@query
def keyword_position(spark, sf_dir):
    return inputs.shows(spark, sf_dir).select("identifier", text.keyword_position(F.col("text"), "the").alias("position"))


@query
def isin_lookup(spark, sf_dir):
    return catalogue.lookup(inputs.shows(spark, sf_dir), "source", ["src3", "src17"]).select("identifier", "text")


@query
def pending_work(spark, sf_dir):
    stored = inputs.shows(spark, sf_dir)
    kinds = {"meta": stored.filter("lang <> 'es'"), "page": stored.filter("lang <> 'de'")}
    return catalogue.pending_work(inputs.listed_shows(spark, sf_dir), kinds)


@query
def ingest_report(spark, sf_dir):
    stored = inputs.shows(spark, sf_dir)
    kinds = {"meta": stored.filter("lang <> 'es'"), "page": stored.filter("lang <> 'de'")}
    tagged = shows.good_tags(_tagged(spark, sf_dir))
    return catalogue.ingest_report(inputs.listed_shows(spark, sf_dir), kinds, tagged)


# --- streaming -----------------------------------------------------------------------


@query
def incremental_ingest(spark, sf_dir):
    work = shared_folder(spark, "ingest")
    raw, target, checkpoint = f"{work}/raw", f"{work}/texts", f"{work}/checkpoint"
    pages = inputs.caption_pages(spark, sf_dir).withColumnRenamed("archive_id", "identifier")
    shorter = inputs.labelled_shows(spark, sf_dir).select("identifier", inputs.page(F.col("lang")).alias("content"))
    late = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("PAGE_"), F.col("page_id").cast("string")).alias("identifier"), inputs.page(F.col("url")).alias("content")
    )
    for arrival in (pages, shorter.unionByName(late)):
        arrival.write.mode("append").parquet(raw)
        ingest(raw_stream(spark, raw), "page", target, checkpoint)
    return spark.read.schema("identifier STRING, text STRING").parquet(target)
