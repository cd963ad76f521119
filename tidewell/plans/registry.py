"""All queries of the scholarly engine over the test tables, and the SQL each must equal."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tidewell.functions import text
from tidewell.operators import graph, store
from tidewell.operators.kept import kept, kept_by, kept_once, tasks_for
from tidewell.plans import identity, institutions, ledger_queries, merges, outputs, provenance, records, reports, researchers, ror, summaries
from tidewell.plans.oracles import ORACLES
from tidewell.plans.views import keyed, view
from tidewell.session import ship
from tidewell.sources import flatten


class Tables:
    """Views and derived layers of a folder of test tables, made when asked for; layers named in keep are written once."""

    def __init__(self, spark, sf_dir, keep=()):
        self.spark, self.dir, self._keep, self._made = ship(spark), sf_dir, keep, {}

    def __getattribute__(self, name):
        get = super().__getattribute__
        if name.startswith("_") or name not in get("_keep"):
            return get(name)
        if name not in self._made:
            try:
                layer = get(name)
            except AttributeError:  # a view
                layer = view(self.spark, self.dir, name)
            self._made[name] = kept_by(layer, BUCKETS[name], self.tasks, name) if name in BUCKETS else kept(layer, name)
        return self._made[name]

    def __getattr__(self, name):
        return view(self.spark, self.dir, name)

    @property
    def works_parsed(self):
        """The raw works, parsed once for all queries of an application."""
        return kept_once("works_parsed", [self.works_raw], lambda: flatten.parsed(self.works_raw))

    @property
    def rw(self):
        return researchers.researcher_works(self.authorships, self.works_flat)

    @property
    def tasks(self):
        """How many tasks share the authorships in steps by work and by author."""
        if "tasks" not in self._made:
            self._made["tasks"] = tasks_for(self.authorships)
        return self._made["tasks"]

    @property
    def topics(self):
        """The topics of works, kept by work, and the list of topics."""
        if "topics" not in self._made:
            tiers = kept_by(researchers.topic_tiers(keyed(self.spark, self.dir, "work_topics", self.tasks), self.curated_topics), "work_id", self.tasks, "topic_tiers")
            self._made["topics"] = tiers, researchers.topic_list(tiers)
        return self._made["topics"]

    @property
    def gathered(self):
        """Authors' rows with all of their works that layers by author read."""
        return researchers.gathered(self.authorships, self.works_flat, self.tasks, *self.topics, self.work_sources)

    @property
    def gathered_topics(self):
        """The same without source names."""
        return researchers.gathered(self.authorships, self.works_flat, self.tasks, *self.topics)

    @property
    def with_topics(self):
        """Whichever of both is written, or the narrower one."""
        return self.gathered if "gathered" in self._keep else self.gathered_topics

    @property
    def rt(self):
        return researchers.researcher_topics(self.with_topics, self.topics[1])

    @property
    def home_rows(self):
        return researchers.home_rows(keyed(self.spark, self.dir, "researcher_institutions", self.tasks)).repartition(self.tasks, "author_id")

    @property
    def home(self):
        return researchers.institution_counts(self.home_rows)

    @property
    def edges(self):
        return graph.coauthor_edges(self.authorships, None)

    @property
    def people(self):
        main = researchers.main_institution(self.home)
        top = researchers.top_topics(self.rt)
        return researchers.author_rows(self.with_topics).join(main, "author_id", "left").join(top, "author_id", "left").select("author_id", "author_name", "orcid", "works", "citations", "main_ror", "main_institution_name", "top_topics")

    @property
    def keyed_people(self):
        return identity.with_keys(self.people)

    @property
    def pairs(self):
        return identity.candidate_pairs(self.keyed_people, graph.shared_works_of(self.with_topics, identity.in_blocks(self.keyed_people), self.tasks, None))

    @property
    def identity_map(self):
        return identity.canonical(self.people, self.pairs)

    @property
    def institution_map(self):
        return institutions.identity_map(self.researcher_institutions)

    @property
    def enriched(self):
        raw, canon = self.ror_raw, institutions.canonical(self.institution_map).select("canonical_institution_id", "canonical_name", "canonical_ror", "canonical_country")
        none = flatten.organisation_lists(raw, "aliases")
        return ror.enriched(canon, flatten.organisations(raw), flatten.organisation_names(raw), none, flatten.organisation_locations(raw), flatten.organisation_relationships(raw), flatten.organisation_ids(raw), flatten.organisation_lists(raw, "links"))

    @property
    def source_ids(self):
        """Numbers of the distinct source keys; only what shows a canonical id needs them."""
        if "source_ids" not in self._made:
            self._made["source_ids"] = outputs.source_ids(self.work_sources)
        return self._made["source_ids"]

    @property
    def canonical(self):
        return outputs.canonical_sources(self.work_sources, self.source_ids)

    @property
    def tags(self):
        return outputs.work_output_tags(self.works_flat, self.work_sources, self.source_ids)

    @property
    def plain_canonical(self):
        return outputs.canonical_sources(self.work_sources)

    @property
    def plain_tags(self):
        """The output layer without canonical ids."""
        return outputs.work_output_tags(self.works_flat, self.work_sources)

    @property
    def fetched(self):
        """A replayed fetch log: every third DOI came back, some with an error."""
        dois = self.works_flat.where("doi is not null and doi != ''").select(text.normalize_doi(F.col("doi")).alias("doi_clean")).distinct()
        digit = F.substring("doi_clean", -1, 1).cast("int")
        return dois.where(digit % 3 == 0).select("doi_clean", F.when(digit % 2 == 0, 200).otherwise(404).alias("response_status"))

    @property
    def reg(self):
        return outputs.registry(self.journal_registry_seed)

    @property
    def coverage(self):
        return outputs.registry_coverage(self.reg, self.plain_tags)

    @property
    def record_rows(self):
        return self.harvest_log.select("record_id", "event_id", "status", "value")


def _candidates(t):
    rows, rt, home = t.gathered, t.rt, t.home
    authors = researchers.author_rows(rows)
    return researchers.candidates(authors, researchers.topic_summary(rt), researchers.top_topics(rt), researchers.main_institution(home), researchers.institution_summary(home), researchers.source_lists(rows), researchers.coauthor_counts(rows, authors, t.tasks), researchers.publication_types(rows.where("known"), F.col("times")))


def _components(t):
    edges = t.pairs.where("confidence IN ('very_high', 'high', 'medium')").select(F.col("author_id_a").alias("a"), F.col("author_id_b").alias("b"))
    return graph.components(None, edges).select(F.col("node").alias("author_id"), "component")


def _upsert(t):
    """Of all sightings, those of every second run are in the table, the others come in."""
    rows = t.harvest_log.select("record_id", "event_id", "status", "value", "run_id")
    new = F.col("run_id").isin("run1", "run3")
    return store.upsert(rows.where(~new), rows.where(new), ["record_id"], [F.desc("event_id")]).drop("run_id")


def _insert_absent(t):
    rows = t.record_rows
    old = store.latest(rows.where("event_id < 300"), ["record_id"], [F.asc("event_id")])
    return store.insert_absent(old, rows.where("event_id >= 300"), ["record_id"], [F.asc("event_id")])


def _replace_children(t):
    """The later half of run1's sightings replaces all children of that run's records; all other rows are in the table."""
    rows = t.harvest_log.select("record_id", "event_id", "status", "value", "run_id")
    new = (F.col("run_id") == "run1") & (F.col("event_id") % 2 == 1)
    parents = rows.where("run_id = 'run1'").select("record_id").distinct()
    return store.replace_children(rows.where(~new), rows.where(new), parents, ["record_id"]).drop("run_id")


def _count_seen(t):
    rows = t.harvest_log.select("record_id", "run_id", F.col("event_id").alias("seen_at"))
    old = rows.where("seen_at < 400").groupBy("record_id", "run_id").agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("latest_seen"), F.count("*").alias("seen_count"))
    return store.count_seen(old, rows.where("seen_at >= 400"), ["record_id", "run_id"])


def _json(t):
    parsed = F.from_json("raw_json", "k INT, missing STRING")
    return t.harvest_log.select("event_id", parsed["k"].alias("k"), parsed["missing"].isNull().alias("is_missing"), F.sha1("raw_json").alias("content_hash"))


PLANS = {
    "researcher_works": lambda t: t.rw,
    "researchers_raw": lambda t: researchers.researchers(t.rw),
    "researcher_topics": lambda t: t.rt,
    "topic_summary": lambda t: researchers.topic_summary(t.rt),
    "top_topics": lambda t: researchers.top_topics(t.rt),
    "main_institution": lambda t: researchers.main_institution(t.home),
    "institution_summary": lambda t: researchers.institution_summary(t.home),
    "top_sources": lambda t: researchers.top_sources(t.rw, t.work_sources),
    "coauthor_edges": lambda t: t.edges,
    "coauthor_summary": lambda t: researchers.coauthor_summary(graph.shared_works(t.authorships, None), researchers.researchers(t.rw)),
    "publication_type_summary": lambda t: researchers.publication_types(t.rw),
    "candidate_researchers": _candidates,
    "identity_pairs": lambda t: t.pairs,
    "identity_dropped_blocks": lambda t: identity.dropped_blocks(t.keyed_people),
    "identity_confidence_counts": lambda t: t.pairs.groupBy("confidence").agg(F.count("*").alias("n")),
    "identity_components": _components,
    "canonical_researchers": lambda t: t.identity_map,
    "canonical_metrics": lambda t: identity.canonical_metrics(t.identity_map, t.people, t.gathered_topics, t.rt, t.home_rows, t.tasks),
    "identity_groups": lambda t: identity.groups(t.people, t.pairs),
    "identity_candidate_authors": lambda t: identity.candidate_authors(_candidates(t), identity.groups(t.people, t.pairs)),
    "institution_identity_map": lambda t: t.institution_map,
    "canonical_institutions": lambda t: institutions.canonical(t.institution_map),
    "canonical_researcher_institutions": lambda t: institutions.researcher_links(t.researcher_institutions, t.institution_map),
    "institution_metrics": lambda t: institutions.metrics(institutions.canonical(t.institution_map), institutions.researcher_links(t.researcher_institutions, t.institution_map), t.rw),
    "institution_review_cases": lambda t: institutions.review_cases(t.institution_map),
    "canonical_institutions_enriched": lambda t: t.enriched.select("canonical_institution_id", "canonical_name", "canonical_ror", "ror_name", "ror_status", "relationships", "parents", "related", "related_names", "external_ids", "websites", "has_ror_match"),
    "institution_relationships": lambda t: ror.relationship_edges(institutions.canonical(t.institution_map).where("canonical_ror is not null"), flatten.organisation_relationships(t.ror_raw)).select("canonical_institution_id", "related_ror_id", "label", "relationship_type", "related_institution_id"),
    "institution_websites_cross": lambda t: ror.websites(institutions.canonical(t.institution_map), flatten.organisation_lists(t.ror_raw, "links"), flatten.organisation_lists(t.ror_raw, "domains")).select("canonical_institution_id", "link", "domain"),
    "institution_external_ids": lambda t: ror.external_ids(institutions.canonical(t.institution_map), flatten.organisation_ids(t.ror_raw)).select("canonical_institution_id", "id_type", "id_value", "is_preferred"),
    "policy_organisations": lambda t: ror.policy_organisations(institutions.canonical(t.institution_map), ("000001", "co.")).select("canonical_institution_id", "canonical_name"),
    "text_cleaning_review": lambda t: outputs.text_cleaning_review(t.works_flat, "work_id", "title", normalise=False),
    "canonical_sources": lambda t: t.canonical,
    "work_output_tags": lambda t: t.tags,
    "source_metrics": lambda t: outputs.source_metrics(t.tags),
    "output_type_metrics": lambda t: outputs.output_type_metrics(t.plain_tags),
    "crossref_scope_v1": lambda t: outputs.scope_books_and_missing(t.plain_tags),
    "crossref_scope_all": lambda t: outputs.scope_all(t.plain_tags),
    "crossref_scope_delta": lambda t: outputs.scope_delta(t.plain_tags, t.fetched),
    "crossref_remaining": lambda t: store.not_done(outputs.scope_delta(t.plain_tags).select("doi_clean", "scope_reason"), t.fetched.select("doi_clean"), ["doi_clean"]).groupBy("scope_reason").agg(F.count("*").alias("n")),
    "journal_registry": lambda t: t.reg,
    "registry_identifiers": lambda t: outputs.registry_identifiers(t.reg),
    "registry_coverage": lambda t: t.coverage,
    "registry_missing": lambda t: t.coverage.where("works = 0").select("registry_id", "title"),
    "registry_band_summary": lambda t: outputs.registry_bands(t.coverage),
    "output_class_counts": lambda t: reports.counts(t.plain_tags, "derived_output_class", "broad_output_family"),
    "top_sources_by_class": lambda t: reports.top_sources_by_class(outputs.source_metrics(t.plain_tags), t.plain_canonical),
    "control_char_names": lambda t: reports.odd_names(t.plain_tags),
    "source_name_variants": lambda t: reports.name_variants(t.plain_tags),
    "researcher_output_comparison": lambda t: reports.researcher_outputs(t.rw, t.plain_tags, t.tasks),
    "repository_heavy_researchers": lambda t: reports.repository_heavy(reports.researcher_outputs(t.rw, t.plain_tags, t.tasks)),
    "missing_source_works": lambda t: reports.missing_sources(t.plain_tags),
    "repository_sources": lambda t: reports.sources_like(outputs.source_metrics(t.tags), t.canonical, "is_repository_like"),
    "book_sources": lambda t: reports.sources_like(outputs.source_metrics(t.tags), t.canonical, "is_book_like"),
    "collapsed_institution_variants": lambda t: reports.collapsed_variants(institutions.canonical(t.institution_map)),
    "home_institutions": lambda t: reports.home_institutions(institutions.canonical(t.institution_map), institutions.metrics(institutions.canonical(t.institution_map), institutions.researcher_links(t.researcher_institutions, t.institution_map), t.rw)),
    "fetch_status_counts": lambda t: t.fetched.groupBy("response_status").agg(F.count("*").alias("n")),
    "snapshot_output_summary": lambda t: t.plain_tags.groupBy("broad_output_family", "derived_output_class").agg(F.count("*").alias("works"), F.count_if(F.col("doi").isNotNull() & (F.col("doi") != "")).alias("with_doi"), F.count_if("is_oa").alias("open_access")),
    "top_researchers": lambda t: reports.top_rows(researchers.researchers(t.rw).select("author_id", "author_name", "works", "citations"), [F.desc("works"), F.desc("citations"), F.asc("author_id")], 20),
    "sample_rows": lambda t: reports.sample_rows(reports.missing_sources(t.plain_tags), "work_id", 100),
    "snapshot_missingness": lambda t: reports.missingness(t.works_flat, t.work_sources),
    "snapshot_by_year": lambda t: reports.by_year(t.plain_tags),
    "raw_source_records": lambda t: provenance.raw_records(t.harvest_log.withColumn("k", F.col("event_id").cast("string")), "k", "raw_json", "raw_openalex_work_", F.col("run_id")),
    "source_work_claims": lambda t: provenance.work_claims(t.works_flat, "claim_openalex_work_", "openalex"),
    "work_identifier_claims": lambda t: provenance.identifier_claims(t.works_flat),
    "discovery_summary": lambda t: provenance.discovery_summary(t.harvest_log),
    "upsert_last_wins": _upsert,
    "insert_ignore": _insert_absent,
    "replace_children": _replace_children,
    "seen_counter_upsert": _count_seen,
    "json_flatten_events": _json,
    "nfkc_clean": lambda t: outputs.text_cleaning_review(t.spark.read.parquet(f"{t.dir}/documents.parquet"), "doc_id", "text"),
}
PLANS |= records.PLANS | ledger_queries.PLANS | summaries.PLANS | merges.PLANS


_IDENTITY = ("gathered_topics", "keyed_people")
#: Layers that are written by author: what reads them shuffles nothing to come to its authors.
BUCKETS = dict.fromkeys(("gathered", "gathered_topics", "home", "home_rows", "rt"), "author_id")
#: Layers that a plan reads several times, and that are written for it.
LAYERS = {
    "candidate_researchers": ("gathered", "rt", "home"),
    "identity_pairs": _IDENTITY,
    "identity_confidence_counts": _IDENTITY,
    "identity_components": _IDENTITY,
    "canonical_researchers": ("gathered_topics", "people", "keyed_people"),
    "canonical_metrics": ("gathered_topics", "home_rows", "rt", "people", "keyed_people", "identity_map"),
    "identity_groups": ("gathered_topics", "people", "keyed_people"),
    "identity_candidate_authors": ("gathered", "rt", "home", "people", "keyed_people"),
    "institution_metrics": ("institution_map",),
    "home_institutions": ("institution_map",),
    "canonical_institutions_enriched": ("institution_map",),
    "breakdown_merge_status": ("gathered_topics", "people", "keyed_people"),
    "institution_places": ("institution_map",),
}


def _run(plan, keep, spark, sf_dir):
    return plan(Tables(spark, sf_dir, keep))


def queries() -> dict:
    return {name: partial(_run, plan, LAYERS.get(name, ())) for name, plan in PLANS.items()}


def oracle_sql() -> dict:
    return ORACLES | records.ORACLES | ledger_queries.ORACLES | summaries.ORACLES | merges.ORACLES


def flagship(spark, sf_dir):
    return outputs.source_metrics(Tables(spark, sf_dir).tags)
