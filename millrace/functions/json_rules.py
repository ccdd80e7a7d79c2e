"""Rules over JSON argument columns, compiled once into column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fixed import TOOL_RULES
from millrace.functions.nested import argument_keys


def _is_number(kind):
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _property_rules(value: Column, kind: Column, name, rules):
    """(rule name, broken) pairs for one property; an absent one breaks nothing here.

    ``kind`` is the type name of the value, null when the key is absent.
    """
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    is_text, is_number = kind == "STRING", _is_number(kind)
    broken = []
    if rules.get("type") == "string":
        broken.append((f"type:{name}", ~is_text))
    if rules.get("type") == "number":
        broken.append((f"type:{name}", ~is_number))
    if "minLength" in rules:
        broken.append((f"minLength:{name}", is_text & (F.length(text) < rules["minLength"])))
    if "maxLength" in rules:
        broken.append((f"maxLength:{name}", is_text & (F.length(text) > rules["maxLength"])))
    if "minimum" in rules:
        broken.append((f"minimum:{name}", is_number & (number < rules["minimum"])))
    if "enum" in rules:
        broken.append((f"enum:{name}", ~(is_text & text.isin(rules["enum"]))))
    return broken


def broken_rules(values, kinds, keys: Column, schema) -> Column:
    """Names of the rules an argument object breaks, in schema order.

    ``values`` and ``kinds`` map a property name to its value and type name;
    ``keys`` are the keys of the object.
    """
    found = [(f"required:{name}", kinds[name].isNull()) for name in schema["required"]]
    for name, rules in schema["properties"].items():
        found += _property_rules(values[name], kinds[name], name, rules)
    known = F.array(*[F.lit(name) for name in schema["properties"]])
    found.append(("additionalProperties", F.size(F.array_except(keys, known)) > 0))
    names = F.array(*[F.when(bad, F.lit(rule)) for rule, bad in found])
    # Unlike array_compact this stays in generated code.
    return F.array_except(names, F.array(F.lit(None).cast("string")))


def check_arguments(df: DataFrame, tool, arguments, rules=None) -> DataFrame:
    """Adds ``arg_keys``, ``broken`` (rule names) and ``valid`` for an argument column.

    The text is parsed once, and each property taken out once, whatever the
    number of rules on it.
    """
    rules = TOOL_RULES if rules is None else rules
    users = {}
    for name, schema in rules.items():
        for prop in schema["properties"]:
            users.setdefault(prop, []).append(name)
    parsed = df.withColumn("_parsed", F.try_parse_json(arguments))
    taken = parsed.withColumns(
        {
            f"_v_{prop}": F.when(
                F.col(tool).isin(tools), F.try_variant_get("_parsed", f"$.{prop}", "variant")
            )
            for prop, tools in users.items()
        }
    )
    typed = taken.withColumns(
        {
            **{f"_t_{prop}": F.schema_of_variant(F.col(f"_v_{prop}")) for prop in users},
            "_whole": F.schema_of_variant(F.col("_parsed")),
            "arg_keys": argument_keys(arguments),
        }
    )
    values = {prop: F.col(f"_v_{prop}") for prop in users}
    kinds = {prop: F.col(f"_t_{prop}") for prop in users}
    verdict = F.when(F.col("_whole").isNull(), F.array(F.lit("malformed"))).when(
        ~F.col("_whole").startswith("OBJECT"), F.array(F.lit("type"))
    )
    for name, schema in rules.items():
        broken = broken_rules(values, kinds, F.col("arg_keys"), schema)
        verdict = verdict.when(F.col(tool) == name, broken)
    verdict = verdict.otherwise(F.array(F.lit("unknown_tool")))
    checked = typed.withColumn("broken", verdict)
    added = ["arg_keys", "broken", "valid"]
    return checked.withColumn("valid", F.size("broken") == 0).select(*df.columns, *added)
