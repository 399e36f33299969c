"""Gates on what projects have delivered: many projects at once, from their documents' raw contents.

Documents are JSON, JSON lines, Markdown and tab-separated tables. JSON is read with its types, so that a
number, a string and a missing field differ; what doesn't parse counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators.stages import GLOSSARY_FIELDS
from textloom.sources.typed import attempted, is_object, kind_of, member, settled, truth_of

# Paths of documents and folders below a project.
JSON = {
    "project": "project.json", "manifest": "source/file-manifest.json", "roundtrip": "qa/roundtrip-report.json", "map": "extracted/script-map.json", "tokens": "extracted/control-token-report.json", "version": "bible/version.json", "characters": "bible/characters.json",
    "voice": "bible/voice.json", "routes": "bible/route-knowledge.json", "errors": "qa/global.json", "repack": "qa/repack-report.json", "playtest": "qa/playtest-report.json", "release": "qa/release-report.json",
}
FIELDS = [
    *(("project", field) for field in ("schema_version", "game_name", "source_locale", "target_locale")), ("manifest", "file_count"), ("map", "nodes"), ("tokens", "engines"), ("version", "frozen"), ("version", "version"), ("characters", "characters"),
    ("voice", "characters"), ("voice", "narrator"), ("routes", "global"), ("routes", "routes"), ("errors", "errors"), *((name, "passed") for name in ("roundtrip", "repack", "playtest", "release")),
]
ROUNDTRIP = ["staging/roundtrip/input", "staging/roundtrip/unpacked", "staging/roundtrip/repacked"]


class Known:
    """A JSON value with what the rules ask of it, each a column that is made once for a row."""

    def __init__(self, name: str):
        self.value, self.json, self.kind = F.col(name), F.col(f"{name}_json"), F.col(f"{name}_kind")
        self.truth = truth_of(self.value, self.kind, self.json)
        self.text = F.try_variant_get(self.value, "$", "string")
        #: A whole number; true and false are 1 and 0.
        self.number = F.when(self.kind.isin("integer", "boolean"), F.try_variant_get(self.value, "$", "long"))
        self.is_yes = (self.kind == "boolean") & self.truth  # exactly true
        self.is_zero = self.kind.isin("integer", "number", "boolean") & ~self.truth
        self.is_filled_list = (self.kind == "array") & self.truth
        self.is_object_or_missing = self.kind.isin("object", "missing")
        self.is_text = F.coalesce((self.kind == "string") & (self.text != ""), F.lit(False))


def values_of(projects: DataFrame) -> DataFrame:
    """The projects with the parsed documents (_name) and their FIELDS (_name_field, and its _json and _kind).

    Each step is a projection over the last, as a value that many expressions of one projection name would
    be made again for each of them.
    """
    raw = lambda name: F.col("documents")[JSON[name]]
    fields = [f"_{name}_{field}" for name, field in FIELDS]
    rows = projects.select("project", "files", "documents", *(attempted(raw(name)).alias(f"_{name}") for name in JSON))
    rows = rows.select("project", "files", "documents", *(settled(F.col(f"_{name}"), raw(name)).alias(f"_{name}") for name in JSON))
    rows = rows.select("*", *(member(F.col(f"_{name}"), field).alias(f"_{name}_{field}") for name, field in FIELDS))
    rows = rows.select("*", *(F.schema_of_variant(f).alias(f"{f}_form") for f in fields), *(F.to_json(f).alias(f"{f}_json") for f in fields))
    return rows.select("*", *(kind_of(F.col(f), F.col(f"{f}_form"), F.col(f"{f}_json")).alias(f"{f}_kind") for f in fields))


def split_lines(content: Column) -> Column:
    return F.filter(F.split(F.ltrim(content, F.lit("\ufeff")), "\r\n|[\n\r]"), lambda x: X.strip(x) != "")


def gate_problems(projects: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """project, gate, problem for each rule that a project (project, documents: content by path, files: number
    of files by folder) breaks, at the gates that look at documents and folders.

    jobs (project, status) has the projects' jobs, for the gate validated. A project without documents
    breaks all rules but those for richer schemas; the schema version is the project's own, or 1.
    Rules on source units, plans, bundles and reviews are those of the functions in stages.
    """
    raw = lambda path: F.coalesce(F.col("documents")[path], F.lit(""))
    rows = values_of(projects).withColumns({"_lines": split_lines(raw("bible/calibration.jsonl")), "_table": split_lines(raw("bible/glossary.tsv"))})
    get = lambda name, field: Known(f"_{name}_{field}")
    empty = lambda folder: F.coalesce(F.col("files")[folder], F.lit(0)) <= 0

    schema = F.coalesce(get("project", "schema_version").number, F.lit(1))
    named = get("project", "game_name").truth
    source, target = get("project", "source_locale"), get("project", "target_locale")
    people = F.try_variant_get(get("characters", "characters").value, "$", "array<variant>")
    lines, table = F.col("_lines"), F.col("_table")
    objects = F.zip_with(F.transform(lines, attempted), lines, lambda both, line: is_object(settled(both, line)))
    columns = F.split(F.coalesce(F.try_element_at(table, F.lit(1)), F.lit("")), "\t")
    fields = F.array(*map(F.lit, GLOSSARY_FIELDS))
    rules: list[tuple[str, str, Column]] = [
        ("initialized", "project.json must contain game_name", ~named),
        *(("initialized", f"project.json must contain {name}", named & (schema >= 3) & ~tag.is_text) for name, tag in (("source_locale", source), ("target_locale", target))),
        ("initialized", "source_locale and target_locale must be different", named & (schema >= 3) & (F.lower(source.text) == F.lower(target.text)) & source.is_text & target.is_text),
        ("researched", "manifest describes no file", ~get("manifest", "file_count").truth),
        ("researched", "unpack-notes.md has no meaningful content", ~X.meaningful(raw("research/unpack-notes.md"))),
        ("roundtrip-proven", "roundtrip-report.json must contain passed=true", ~get("roundtrip", "passed").is_yes),
        *(("roundtrip-proven", f"{folder} is empty", empty(folder)) for folder in ROUNDTRIP),
        ("extracted", "script-map.json has no scene nodes", ~get("map", "nodes").is_filled_list),
        ("extracted", "control-token-report.json has no engine inventory", ~get("tokens", "engines").is_filled_list),
        ("bible-frozen", "version.json must be frozen at version >= 1", ~(get("version", "frozen").is_yes & F.coalesce(get("version", "version").number >= 1, F.lit(False)))),
        *(("bible-frozen", f"{name}.md has no meaningful content", ~X.meaningful(raw(f"bible/{name}.md")) & (schema >= least)) for name, least in (("world", 0), ("honorifics", 0), ("language-profile", 3))),
        ("bible-frozen", "characters.json has no characters", ~(get("characters", "characters").is_filled_list & F.coalesce(F.forall(people, is_object), F.lit(False)))),
        ("bible-frozen", "voice.json has no voice definitions", ~(is_object(F.col("_voice")) & get("voice", "characters").is_object_or_missing & get("voice", "narrator").is_object_or_missing & (get("voice", "characters").truth | get("voice", "narrator").truth))),
        ("bible-frozen", "route-knowledge.json is invalid", ~(is_object(F.col("_routes")) & get("routes", "global").is_object_or_missing & get("routes", "routes").is_object_or_missing)),
        ("bible-frozen", "calibration.jsonl has no approved examples", (F.size(lines) == 0) | ~F.forall(objects, lambda x: x)),
        ("bible-frozen", "glossary.tsv has no terminology rows", F.size(table) < 2),
        ("bible-frozen", "glossary.tsv lacks required columns", F.size(F.array_except(fields, columns)) > 0),
        ("validated", "global.json must report errors=0", ~get("errors", "errors").is_zero),
        ("repacked", "build is empty", empty("build")),
        *((gate, f"{name}-report.json must contain passed=true", ~get(name, "passed").is_yes) for gate, name in (("repacked", "repack"), ("playtested", "playtest"), ("released", "release"))),
        ("released", "release is empty", empty("release")),
    ]
    found = F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(gate).alias("gate"), F.lit(text).alias("problem"))) for gate, text, bad in rules))
    out = rows.select("project", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("p")).select("project", "p.gate", "p.problem")
    if jobs is None:
        return out
    waiting = jobs.filter(~F.coalesce(F.col("status").isin("approved", "merged"), F.lit(False))).select("project").distinct()
    return out.unionAll(projects.select("project").join(waiting, "project", "left_semi").select("project", F.lit("validated").alias("gate"), F.lit("all jobs must be approved or merged").alias("problem")))
