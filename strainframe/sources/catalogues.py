"""Frozen provider catalogues, and raw bundles of them with the responses that type their genomes.

A catalogue is one JSON file: search pages, a detail for each genome, the rows
that were made of them, and digests of all.  Files are judged in parallel;
identities are reconciled by joins.  What a catalogue's rows say is never
taken over: records are made anew from pages and details.

A raw bundle pins catalogues and typing responses of several scopes by a
manifest.  A scope that lacks some responses still gives its records; their
genomes are told as missing.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import scalars as S
from . import files
from .records import RECORD, as_type, field

# The fields of a detail and of its metadata in which a country stands, by precedence.
COUNTRY_FIELDS = ["Country", "country", "country of origin", "geo_loc_name"]
# The fields of a detail that name accessions.
ACCESSION_FIELDS = ["name", "sampleAccession", "runAccession", "assemblyAccession", "studyAccession"]


def content_hash(value: object) -> str:
    """Digest of a JSON value in canonical form: keys sorted, no spaces, no escapes."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def digests(texts: pd.Series) -> pd.DataFrame:
    """Digests of a catalogue's sections; all null for what is no JSON object."""
    out = []
    for text in texts:
        try:
            data = json.loads(text)
            parts = ({k: v for k, v in data.items() if k != "snapshot_sha256"}, data.get("rows"), data.get("raw_details"), data.get("raw_search_pages"), (data.get("provenance") or {}).get("query"))
            out.append([content_hash(p) for p in parts])
        except (ValueError, AttributeError, TypeError):
            out.append([None] * 5)
    return pd.DataFrame(out, columns=["snapshot", "rows", "details", "pages", "query"])


def get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


class Catalogues:
    """Catalogue files, their problems, and the records of those without one."""

    def __init__(self, texts: DataFrame):
        """``texts`` are (file, value)."""
        own = F.pandas_udf(digests, "snapshot string, rows string, details string, pages string, query string")
        top = texts.select("file", F.try_parse_json("value").alias("v"), own("value").alias("own"))
        p = lambda name, kind="string": get(F.col("v"), f"$.provenance.{name}", kind)
        self.top = top.select(
            "file", "own", as_type(F.col("v"), RECORD).alias("record"), get(F.col("v"), "$.schema_version", "int").alias("version"), get(F.col("v"), "$.snapshot_sha256").alias("snapshot"),
            get(F.col("v"), "$.rows", "array<variant>").alias("rows"), get(F.col("v"), "$.raw_details", RECORD).alias("details"), get(F.col("v"), "$.raw_search_pages", "array<variant>").alias("pages"),
            p("complete", "boolean").alias("complete"), p("public_only", "boolean").alias("public_only"), p("expected_count", "long").alias("expected"), p("raw_record_count", "long").alias("counted"),
            p("rows_sha256").alias("rows_sha"), p("raw_details_sha256").alias("details_sha"), p("raw_search_sha256").alias("pages_sha"), p("query_sha256").alias("query_sha"),
            p("species").alias("species"), p("query.organismId").alias("organism"), F.coalesce(p("query.mlst[0]"), p("query.mlst2[0]")).alias("st"), F.when(p("query.mlst", "array<variant>").isNotNull(), "mlst").otherwise("mlst2").alias("scheme"),
        )
        found = lambda name, column: ~F.coalesce(F.col(f"own.{name}") == F.col(column), F.lit(False))
        sizes = (F.size("rows").cast("long") == F.size("details")) & (F.size("rows").cast("long") == F.col("expected")) & (F.col("expected") == F.col("counted"))
        paged = F.forall("pages", lambda x: F.coalesce((get(x, "$.meta.count", "long") == F.col("expected")) & get(x, "$.genomes", "array<variant>").isNotNull(), F.lit(False))) & (F.size("pages") > 0)
        rules = {
            "snapshot_differs": found("snapshot", "snapshot"), "rows_differ": found("rows", "rows_sha"), "details_differ": found("details", "details_sha"), "pages_differ": found("pages", "pages_sha"), "query_differs": found("query", "query_sha"),
            "not_complete": ~(F.coalesce("complete", F.lit(False)) & F.coalesce("public_only", F.lit(False))), "counts_disagree": ~F.coalesce(sizes, F.lit(False)), "pages_disagree": ~F.coalesce(paged, F.lit(False)),
        }
        first = F.when(F.col("record").isNull(), "not_an_object").when(~F.col("version").eqNullSafe(F.lit(1)), "unsupported_schema")
        broken = F.array_compact(F.array(*(F.when(bad, name) for name, bad in rules.items())))
        self.whole = self.top.select("file", F.explode(F.when(first.isNotNull(), F.array(first)).otherwise(broken)).alias("problem"))
        self.search = self.top.select("file", F.explode("pages").alias("page")).select("file", F.explode(get(F.col("page"), "$.genomes", "array<variant>")).alias("search")).withColumn("id", get(F.col("search"), "$.uuid"))
        self.details = self.top.select("file", F.explode("details").alias("id", "detail"))
        self.rows = self.top.select("file", F.explode("rows").alias("row")).select("file", get(F.col("row"), "$.source_genome_id").alias("id"))

    def problems(self) -> DataFrame:
        """(file, id, problem): id is null for a whole file."""
        twice = lambda df, name: df.groupBy("file", "id").agg(F.count("*").alias("n")).where("n > 1 or id is null").select("file", "id", F.lit(name).alias("problem"))
        lacks = lambda df, other, name: df.select("file", "id").distinct().join(other.select("file", "id").distinct(), ["file", "id"], "left_anti").where("id is not null").select("file", "id", F.lit(name).alias("problem"))
        out = self.whole.select("file", F.lit(None).cast("string").alias("id"), "problem")
        for part in (
            twice(self.search, "repeated_search"), twice(self.rows, "repeated_row"), lacks(self.search, self.details, "search_without_detail"), lacks(self.details, self.search, "detail_without_search"),
            lacks(self.rows, self.details, "row_without_detail"), lacks(self.details, self.rows, "detail_without_row"), self.record_problems(),
        ):
            out = out.unionByName(part)
        return out

    def met(self) -> DataFrame:
        """Searches with their details and scopes."""
        scopes = self.top.select("file", "species", "organism", "st", "scheme")
        return self.search.where("id is not null").join(self.details, ["file", "id"]).join(scopes, "file")

    def record_problems(self) -> DataFrame:
        d, s = F.col("detail"), F.col("search")
        typed = F.when(F.col("scheme") == "mlst", get(d, "$.mlst")).otherwise(get(d, "$.mlst2"))
        qc = F.schema_of_variant(get(d, "$.qc", "variant"))
        why = (
            F.when(~get(d, "$.uuid").eqNullSafe(F.col("id")), "detail_of_another")
            .when(~get(s, "$.projectAccess").eqNullSafe(F.lit("PUBLIC")) | (F.coalesce(get(d, "$.projectAccess"), F.lit("PUBLIC")) != "PUBLIC"), "not_public")
            .when(~get(d, "$.organismId").eqNullSafe(F.col("organism")) | ~typed.eqNullSafe(F.col("st")), "other_scope")
            .when(qc.isNotNull() & ~qc.isin("BOOLEAN", "VOID"), "invalid_qc")
        )
        return self.met().select("file", "id", why.alias("problem")).where("problem is not null")

    def records(self, lookup: Column) -> DataFrame:
        """The genomes of catalogues without any problem, made anew from pages and details, as records with ``id`` and ``file``.

        ``lookup`` maps country codes and names.
        """
        good = self.met().join(self.problems().select("file").distinct(), "file", "left_anti")
        d, s = F.col("detail"), F.col("search")
        # Metadata is an object or a list of pairs.
        listed = get(d, "$.metadata", "array<variant>")
        pairs = F.filter(F.transform(listed, lambda x: F.struct(get(x, "$[0]").alias("key"), get(x, "$[1]").alias("value"))), lambda x: x["key"].isNotNull())
        # Of a repeated key the last pair counts.
        keys = F.array_distinct(F.transform(pairs, lambda x: x["key"]))
        last = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda x: x["key"] == k), -1)["value"]))
        meta = F.coalesce(get(d, "$.metadata", "map<string, string>"), last, F.create_map().cast("map<string, string>"))
        rows = good.withColumn("meta", meta)
        named = F.concat(F.transform(F.array(*map(F.lit, COUNTRY_FIELDS)), lambda k: F.try_element_at("meta", k)), F.array(F.coalesce(get(d, "$.location.country"), get(d, "$.location")), F.coalesce(get(s, "$.location.country"), get(s, "$.location"))))
        found = F.filter(F.transform(F.filter(named, lambda x: x.isNotNull() & (x != "")), lambda x: S.country_name(x, lookup)), lambda x: x.isNotNull())
        start, end, precision = D.ingest(F.coalesce(F.try_element_at("meta", F.lit("collection_date")), get(d, "$.date"), F.lit("")))
        accessions = S.strong_accessions(*(get(d, f"$.{n}") for n in ACCESSION_FIELDS), F.array_join(F.map_values("meta"), " "))
        kinds = F.transform(accessions, S.accession_kind)
        of = lambda kind: F.filter(accessions, lambda x: S.accession_kind(x) == kind)
        return rows.select(
            "file", "id", "species", F.col("st").alias("mlst_st"), F.col("scheme").alias("mlst_scheme"), F.coalesce(get(d, "$.name"), F.col("id")).alias("sample_id"), get(d, "$.id", "long").alias("numeric_id"), get(d, "$.qc", "boolean").alias("qc_pass"),
            F.coalesce(F.try_element_at(found, F.lit(1)), F.lit("Unknown")).alias("country"), (F.size(F.array_distinct(found)) > 1).alias("country_conflict"),
            F.coalesce(F.try_element_at("meta", F.lit("Host")), F.try_element_at("meta", F.lit("host")), F.lit("")).alias("host"), start.cast("string").alias("date_start"), end.cast("string").alias("date_end"), precision.alias("date_precision"),
            accessions.alias("accessions"), kinds.alias("accession_kinds"), of("biosample").alias("biosamples"), of("run").alias("runs"),
        )


def catalogue_files(spark: SparkSession, path: str) -> Catalogues:
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return Catalogues(texts.select(F.col("_metadata.file_path").alias("file"), "value"))


class RawBundle:
    """A folder of catalogues and typing responses that a manifest pins."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, lookup: Column, manifest: str = "provider-source.json"):
        self.spark, self.folder = spark, folder
        whole = spark.read.text(f"{folder}/{manifest}", wholetext=True).select(F.try_parse_json("value").alias("v"), F.col("value").alias("text"))

        @F.pandas_udf("string")
        def own_hash(texts: pd.Series) -> pd.Series:
            out = []
            for text in texts:
                try:
                    out.append(content_hash({k: v for k, v in json.loads(text).items() if k != "snapshot_sha256"}))
                except (ValueError, AttributeError):
                    out.append(None)
            return pd.Series(out, dtype=object)

        judged = whole.withColumn("own", own_hash("text"))
        wrong = F.when(F.col("v").isNull(), "not_json").when(~get(F.col("v"), "$.schema").eqNullSafe(F.lit(schema)) | ~get(F.col("v"), "$.schema_version", "int").eqNullSafe(F.lit(1)), "unsupported_schema").when(~get(F.col("v"), "$.snapshot_sha256").eqNullSafe(F.col("own")), "manifest_differs")
        self.head = judged.select(wrong.alias("problem")).where("problem is not null")
        scopes = whole.select(F.posexplode(get(F.col("v"), "$.scopes", "array<variant>")).alias("scope", "s")).withColumn("record", as_type(F.col("s"), RECORD))
        self.scopes = scopes.select("scope", get(F.col("s"), "$.scope.species").alias("species"), get(F.col("s"), "$.scope.st").alias("st"), get(F.col("s"), "$.catalogue.path").alias("catalogue"))
        receipts = scopes.select("scope", F.posexplode(field("receipts", "array<variant>")).alias("batch", "r"))
        self.batches = receipts.select("scope", "batch", get(F.col("r"), "$.saved_response_path").alias("path"), get(F.col("r"), "$.source_genome_ids", "array<string>").alias("ids"))
        entry = lambda v, name, size="bytes", sha="sha256": (get(v, f"$.{name}").alias("path"), get(v, f"$.{size}", "long").alias("bytes"), get(v, f"$.{sha}").alias("sha256"))
        self.entries = scopes.select("scope", get(F.col("s"), "$.catalogue", "variant").alias("c")).select("scope", *entry(F.col("c"), "path")).unionByName(receipts.select("scope", *entry(F.col("r"), "saved_response_path", "response_bytes", "response_sha256")))
        at = files.without_scheme(F.lit(folder.rstrip("/")))
        below = lambda file: F.substring(files.without_scheme(file), F.length(at) + 2, F.lit(1 << 20))
        texts = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(below(F.col("_metadata.file_path")).alias("file"), "value")
        self.catalogues = Catalogues(texts.join(self.scopes.select(F.col("catalogue").alias("file")).distinct(), "file", "left_semi"))
        self.lookup = lookup
        # Responses are long exports: one genome, locus and allele a line.
        lines = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").schema("genome string, locus string, allele string").csv(folder)
        self.lines = lines.select(below(F.col("_metadata.file_path")).alias("path"), "genome", "locus", F.trim("allele").alias("allele"))

    def problems(self) -> DataFrame:
        """(scope, name, problem): of the manifest, of files, of catalogues, and of responses against what was asked."""
        files_of = files.checked(self.spark, self.folder, self.entries).where("problem is not null").where(~F.col("path").rlike("^[^/]*provider-source[^/]*$"))
        at = self.entries.select("scope", "path").distinct()
        found = self.head.select(F.lit(None).cast("int").alias("scope"), F.lit(None).cast("string").alias("name"), "problem")
        found = found.unionByName(files_of.join(at, "path", "left").select("scope", F.col("path").alias("name"), "problem"))
        own = self.scopes.select("scope", F.col("catalogue").alias("file"))
        found = found.unionByName(self.catalogues.problems().join(own, "file").select("scope", F.coalesce("id", "file").alias("name"), "problem"))
        asked = self.batches.select("scope", "batch", "path", F.explode("ids").alias("id"))
        got = self.lines.select("path", F.col("genome").alias("id")).distinct()
        listed = self.batches.select("scope", "path")
        found = found.unionByName(got.join(asked, ["path", "id"], "left_anti").join(listed, "path").select("scope", F.col("id").alias("name"), F.lit("not_requested").alias("problem")))
        found = found.unionByName(asked.groupBy("scope", "id").agg(F.count("*").alias("n")).where("n > 1").select("scope", F.col("id").alias("name"), F.lit("repeated_request").alias("problem")))
        genomes = self.catalogues.search.join(own, "file").select("scope", "id").distinct()
        found = found.unionByName(genomes.join(asked, ["scope", "id"], "left_anti").select("scope", F.col("id").alias("name"), F.lit("not_asked_for").alias("problem")))
        return found.unionByName(asked.select("scope", "id").join(genomes, ["scope", "id"], "left_anti").select("scope", F.col("id").alias("name"), F.lit("not_in_catalogue").alias("problem")))

    def records(self) -> DataFrame:
        """(scope, sample_id, ..., typed, profile): every genome of the scopes without problems; those that no response tells of have ``typed`` = missing."""
        bad = self.problems().select("scope").distinct()
        whole = self.scopes.join(F.broadcast(self.head.limit(1)), F.lit(True), "left_anti").join(bad.where("scope is not null"), "scope", "left_anti")
        genomes = self.catalogues.records(self.lookup).join(whole.select("scope", F.col("catalogue").alias("file")), "file")
        called = self.lines.join(self.batches.select("scope", "path"), "path").where("allele is not null and allele not in ('', '?', '-')")
        profile = called.groupBy("scope", F.col("genome").alias("id")).agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("locus", "allele")))).alias("profile"))
        return genomes.join(profile, ["scope", "id"], "left").withColumn("typed", F.when(F.col("profile").isNull(), "missing").otherwise("assigned")).drop("file")

    def for_scope(self, species: str, st: str) -> DataFrame:
        """The records of exactly one scope; none or several are an error."""
        chosen = [r["scope"] for r in self.scopes.where((F.lower("species") == species.lower()) & (F.col("st") == st)).select("scope").limit(2).collect()]
        if len(chosen) != 1:
            raise ValueError(f"the bundle does not hold exactly one scope {species} {st}")
        return self.records().where(F.col("scope") == chosen[0])
