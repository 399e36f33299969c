"""Text-localization dataflow on Spark: checks, plans, reviews, merges and audits of text units."""
