"""The engine's functions under names that SQL can use."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wagewright.functions import pay

#: name(parameters) and the expression that it stands for; Catalyst puts it in place of the call.
EXPRESSIONS = {
    "pay_size_band(p BIGINT) RETURNS STRING": "CASE WHEN p >= 1000000 THEN 'metro' WHEN p >= 250000 THEN 'large' WHEN p >= 50000 THEN 'medium' WHEN p > 0 THEN 'small' END",
    "pay_annual(v DOUBLE, period STRING, currency STRING, gross_net STRING, months INT) RETURNS DOUBLE": """CASE WHEN coalesce(currency, 'EUR') = 'EUR' AND coalesce(gross_net, '') <> 'net'
        THEN CASE WHEN period = 'year' AND v BETWEEN 5000 AND 500000 THEN v WHEN period = 'month' AND v * months BETWEEN 5000 AND 500000 THEN v * months END END""",
    "pay_share(n BIGINT, total BIGINT) RETURNS DOUBLE": "bround(100 * n / nullif(total, 0), 1)",
    "pay_shown(low DOUBLE, high DOUBLE) RETURNS STRING": "CASE WHEN low IS NULL THEN 'not_stated' WHEN high IS NULL OR high = low THEN concat('€', format_number(low, 0)) ELSE concat('€', format_number(low, 0), ' - €', format_number(high, 0)) END",
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to a session; returns their names."""
    for head, body in EXPRESSIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udf.register("pay_parse", pay._parsed)
    spark.udf.register("pay_list", pay.pay_list)
    spark.udtf.register("pay_mentions", pay.PayMentions)
    return [h.split("(")[0] for h in EXPRESSIONS] + ["pay_parse", "pay_list", "pay_mentions"]
