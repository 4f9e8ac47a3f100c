"""License scan by ordered signature rules, with DataFrame functions only.

A text's words are compared with the rules' key words once; only rules all of whose keys are words of the text are
tried, and most texts hold none. Matches of all rules are intervals of words. One that lies within another of at least
its priority is suppressed (of equal ones the earlier rule stays), so a name with its version takes the place of the name
alone. All of this happens within a row: nothing is shuffled, and no row depends on another.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.decontaminate import exact_words
from wagewright.llm.license_rules import WEIGHTS, Rule, rules_of

RULE = "struct<order int, label string, priority int, keys array<array<string>>, expression string, base boolean>"
#: first and stop are numbers of words from 0; back is -stop, so that structs sort as the sweep reads them.
MATCH = "struct<first int, back int, priority int, order int, label string, base boolean>"
FOUND = "array<struct<label string, rule int, priority int, first_word int, last_word int, base boolean>>"


def rules_column(rules: list[Rule]) -> Column:
    """The rules by each word that can be their first key, as one constant."""
    by_key: dict[str, list[dict]] = {}
    for rule in rules:
        for key in rule.keys[0]:
            by_key.setdefault(key, []).append(rule._asdict())
    return F.from_json(F.lit(json.dumps(by_key, ensure_ascii=False)), f"map<string, array<{RULE}>>")


def key_words(rules: list[Rule]) -> Column:
    return F.array(*(F.lit(k) for k in sorted({k for rule in rules for keys in rule.keys for k in keys})))


def candidates(held: Column, rules: list[Rule]) -> Column:
    """The rules all of whose keys are among the words in held."""
    tried = F.flatten(F.transform(held, lambda k: F.coalesce(F.element_at(rules_column(rules), k), F.array().cast(f"array<{RULE}>"))))
    return F.filter(tried, lambda r: F.forall(r["keys"], lambda either: F.arrays_overlap(either, held)))


def count_of(text: Column) -> Column:
    """Words of a text in which each has a blank before and one after it."""
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("int")


def matches(text: Column, rule: Column, hits: Column) -> Column:
    """Where hits, all matches of a rule in text, stand: what is between them is counted in words."""
    between = F.slice(F.split(text, rule["expression"], -1), 1, F.size(hits))
    spans = F.zip_with(between, hits, lambda gap, hit: F.struct(count_of(gap).alias("gap"), count_of(hit).alias("n")))

    def add(acc: Column, s: Column) -> Column:
        first, stop = acc["at"] + s["gap"], acc["at"] + s["gap"] + s["n"]
        match = F.struct(first.alias("first"), (-stop).alias("back"), rule["priority"].alias("priority"), rule["order"].alias("order"), rule["label"].alias("label"), rule["base"].alias("base"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(match)).alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{MATCH}>").alias("out")), add, lambda acc: acc["out"])


def suppressed(found: Column) -> Column:
    """found in order, without what lies within another match of at least its priority.

    One pass in the order of first words, longer ones first: a match lies within an earlier one if the farthest end of
    any of at least its priority isn't before its own.
    """
    def see(acc: Column, m: Column) -> Column:
        stop = -m["back"]
        covered = F.array_max(F.slice(acc["stops"], 1, m["priority"])) >= stop
        stops = F.transform(acc["stops"], lambda s, p: F.when(p + 1 == m["priority"], F.greatest(s, stop)).otherwise(s))
        return F.struct(stops.alias("stops"), F.when(covered, acc["out"]).otherwise(F.concat(acc["out"], F.array(m))).alias("out"))

    start = F.struct(F.array(*(F.lit(-1) for _ in WEIGHTS)).alias("stops"), F.array().cast(f"array<{MATCH}>").alias("out"))
    return F.aggregate(found, start, see, lambda acc: acc["out"])


def detected(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, found, kept: all matches in a text, and those that no other suppresses.

    Both are arrays of label, rule, priority, first_word, last_word (numbers of words from 0, both within the match) and
    base, in the order of their places. Null and empty texts have no words and no matches. Repeated rows are judged alike,
    each by itself; columns besides doc_id and text are ignored, whatever their names. An empty table gives no rows.
    """
    rules = rules or rules_of()
    words = docs.select("doc_id", exact_words(F.col("text")).alias("words"))
    gated = words.withColumn("held", F.array_intersect("words", key_words(rules))).withColumn("tried", candidates(F.col("held"), rules))
    said = F.when(F.size("tried") > 0, F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))).otherwise("")
    texts = gated.select("doc_id", F.size("words").cast("long").alias("n_words"), "tried", said.alias("said"))
    hits = F.transform("tried", lambda r: F.struct(r.alias("rule"), F.regexp_extract_all("said", r["expression"], F.lit(0)).alias("hits")))
    texts = texts.withColumn("hits", F.filter(hits, lambda h: F.size(h["hits"]) > 0)).drop("tried")
    found = F.array_sort(F.flatten(F.transform("hits", lambda h: matches(F.col("said"), h["rule"], h["hits"]))))
    texts = texts.select("doc_id", "n_words", found.alias("found"))
    texts = texts.withColumn("kept", suppressed(F.col("found")))
    named = lambda c: F.transform(c, lambda m: F.struct(m["label"].alias("label"), m["order"].alias("rule"), m["priority"].alias("priority"), m["first"].alias("first_word"), (-m["back"] - 1).alias("last_word"), m["base"].alias("base"))).cast(FOUND)
    return texts.select("doc_id", "n_words", named("found").alias("found"), named("kept").alias("kept"))


def scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each row of docs.

    The base phrases' places all count, suppressed or not. score is the weight of the surest match's priority, 0
    without any. Odd rows: see ``detected``.
    """
    base = F.filter("found", lambda m: m["base"])
    firsts = F.transform(base, lambda m: m["first_word"].cast("long"))
    distinct = lambda labels: F.concat_ws(",", F.array_sort(F.array_distinct(labels)))
    weights = F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv))
    return detected(docs, rules).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        distinct(F.transform(base, lambda m: m["label"])).alias("base_labels"), distinct(F.concat(F.transform(base, lambda m: m["label"]), F.transform("kept", lambda m: m["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda m: F.element_at(weights, m["priority"]))), F.lit(0.0)).alias("score"),
    )


def _oracle_sql() -> str:
    count = lambda x: f"(strlen({x}) - strlen(replace({x}, ' ', ''))) // 2"
    rows = ", ".join(f"({r.order}, '{r.label}', {r.priority}, '{r.expression}', {r.base}, [{', '.join(str(list(k)) for k in r.keys)}])" for r in rules_of())
    words = sorted({k for r in rules_of() for keys in r.keys for k in keys})
    weights = " ".join(f"WHEN {p} THEN {w}::DOUBLE" for p, w in WEIGHTS.items())
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), rules(ord, label, priority, expression, base, keys) AS (VALUES {rows}
), t AS (SELECT r, list_intersect(w, {words}) AS w, ' ' || array_to_string(w, '  ') || ' ' AS said FROM d WHERE list_has_any(w, {words})
), h AS (
  SELECT r, ord, label, priority, base, regexp_extract_all(said, expression) AS hits, string_split_regex(said, expression) AS pieces
  FROM t, rules WHERE list_has_any(w, keys[1]) AND len(list_filter(keys, lambda k: NOT list_has_any(w, k))) = 0 AND regexp_matches(said, expression)
), n AS (SELECT r, ord, label, priority, base, unnest(range(1, len(hits) + 1)) AS i, hits, pieces FROM h
), m AS (
  SELECT r, ord, label, priority, base, CAST(list_sum([{count('p')} FOR p IN pieces[:i]]) + coalesce(list_sum([{count('x')} FOR x IN hits[:i - 1]]), 0) AS BIGINT) AS first, {count('hits[i]')} AS len FROM n
), k AS (
  SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.r = m.r AND o.priority <= m.priority AND o.first <= m.first AND o.first + o.len >= m.first + m.len
    AND (o.len > m.len OR o.priority < m.priority OR o.ord < m.ord))
), b AS (SELECT r, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM m WHERE base GROUP BY r
), l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM k UNION ALL SELECT r, label FROM m WHERE base) GROUP BY r
), s AS (SELECT r, max(CASE priority {weights} END) AS score FROM k GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r) LEFT JOIN s USING (r)
"""


ORACLE_SQL = _oracle_sql()
