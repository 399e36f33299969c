"""Schemas of the entities that flow through the operators. Every table of text units carries `ord`."""

from __future__ import annotations

# DDL of each entity; extra columns pass through the operators that keep rows.
SOURCE_UNIT = """ord bigint, id string, source_hash string, file string, route string, scene_id string, kind string, speaker string,
    voice_id string, text string, protected_tokens array<string>, boundary_before boolean, merge_group string"""
DRAFT = "ord bigint, id string, translation string, confidence string, source_hash string"
REVIEW_DELTA = "ord bigint, id string, reviewer_translation string, reason string, severity string"
GLOSSARY = "source string, target string, source_locale string, target_locale string, status string, scope string, match_mode string, case_sensitive string"
JOB = """job_id string, status string, route string, scene_ids array<string>, source_files array<string>, entry_ids array<string>,
    speakers array<string>, source_char_count bigint, estimated_source_tokens bigint, source_digest string, bible_version bigint,
    plan_approved boolean, predecessors array<string>, adjacent_entry_ids array<string>, context_notes string"""
ISSUE = "severity string, code string, id string, message string"
EDGE = "src string, dst string"
