"""Gates read each value of a project's documents once."""

from textloom.plans import gates


def test_schemas_and_texts_of_values_are_made_once(spark, sf_dir):
    plan = gates.project_gates(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schema_of_variant") + plan.count("SchemaOfVariant") + plan.count("schemaOfVariant") <= 25
    assert plan.count("to_json") + plan.count("toJson") <= 25
