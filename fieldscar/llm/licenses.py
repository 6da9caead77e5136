"""Licence recognition: sentences become identifiers of known licence sentences, and runs of
identifiers are matched with ordered licence rules. DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import cut_lineage
from .common import register, table

# Sentences of public licence texts and notices, as they are published.
SENTENCES = {
    "mit-line": "Released under the MIT License.",
    "mit-line-2": "This project is licensed under the MIT License.",
    "mit-line-3": "Licensed under the MIT License.",
    "mit-title": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0.",
    "cc0-line": "Released under CC0 1.0.",
    "reserved": "All rights reserved.",
}
#: (rule, licence, sentence identifiers in order). A rule matches neighbouring known sentences.
RULES = [
    ("mit-short", "MIT", ["mit-line"]), ("mit-short-2", "MIT", ["mit-line-2"]), ("mit-short-3", "MIT", ["mit-line-3"]),
    ("mit-titled", "MIT", ["mit-title"]),
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("mit-titled-text", "MIT", ["mit-title", "mit-grant", "mit-notice", "mit-warranty", "mit-liability"]),
    ("mit-part", "MIT", ["mit-grant"]),
    ("apache-short", "Apache-2.0", ["apache-line"]), ("apache-part", "Apache-2.0", ["apache-notice"]),
    ("apache-header", "Apache-2.0", ["apache-notice", "apache-copy", "apache-warranty", "apache-see"]),
    ("gpl3-short", "GPL-3.0", ["gpl3-line"]), ("gpl3-part", "GPL-3.0-or-later", ["gpl-free"]),
    ("gpl3-header", "GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-details"]),
    ("gpl2-part", "GPL-2.0-or-later", ["gpl2-free"]),
    ("gpl2-header", "GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-details"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names"]),
    ("isc-text", "ISC", ["isc-grant"]), ("mpl2-header", "MPL-2.0", ["mpl-notice"]),
    ("cc-by-nc-short", "CC-BY-NC-4.0", ["cc-by-nc-line"]), ("cc-by-short", "CC-BY-4.0", ["cc-by-line"]),
    ("cc-by-sa-short", "CC-BY-SA-4.0", ["cc-by-sa-line"]), ("cc0-short", "CC0-1.0", ["cc0-line"]),
    ("reserved", "all-rights-reserved", ["reserved"]),
]
# The comparison SQL is made of the two above and knows each text by its first sentence. The operator compares
# every sentence of a text, and knows these as well.
MORE_SENTENCES = {
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
    "gpl2-only-2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "agpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-details": "See the GNU Affero General Public License for more details.",
}
#: ``id/k`` is sentence k of a text, a plain identifier all its sentences in order.
MORE_RULES = [
    ("apache-part", "Apache-2.0", ["apache-notice/0"]),
    ("gpl3-version", "GPL-3.0-or-later", ["gpl-free/1"]), ("gpl2-version", "GPL-2.0-or-later", ["gpl2-free/1", "gpl2-free/2"]),
    ("gpl2-only-part", "GPL-2.0-only", ["gpl2-only"]), ("gpl2-only-part-2", "GPL-2.0-only", ["gpl2-only-2"]),
    ("gpl2-only-header", "GPL-2.0-only", ["gpl2-only", "gpl-hope", "gpl-details"]),
    ("gpl2-only-header-2", "GPL-2.0-only", ["gpl2-only-2", "gpl-hope", "gpl-details"]),
    ("agpl3-version", "AGPL-3.0-or-later", ["agpl-free/1"]), ("agpl3-part", "AGPL-3.0-or-later", ["agpl-free"]),
    ("agpl3-header", "AGPL-3.0-or-later", ["agpl-free", "gpl-hope", "agpl-details"]),
]
ALL_SENTENCES, ALL_RULES = SENTENCES | MORE_SENTENCES, RULES + MORE_RULES
#: Unknown sentences that may stand between two neighbours of a rule (list marks, split headings).
MAX_GAP = 2
LONGEST = max(len(ids) for _, _, ids in RULES)

SENTENCE_END = r"[.!?:;]+(?=\s|$)|\n"
NOISE = "[^a-z0-9]+"
HARD = "|"


def lines_and_sentences(text: Column) -> Column:
    """Pieces of the text between sentence ends and line breaks, in lower case, other characters than a-z and 0-9
    as single spaces, empty ones left out. A piece after a sentence end or an empty line begins with HARD."""
    ended = F.regexp_replace(F.lower(text), r"[.!?:;]+(?=\s|$)", "\n\n")
    spaced = F.regexp_replace(F.regexp_replace(ended, r"[^a-z0-9\n]+", " "), " ?\n ?", "\n")
    return F.filter(F.split(F.trim(F.regexp_replace(spaced, "\n\n+", f"\n{HARD}")), "\n"), lambda s: ~s.isin("", HARD))


def parts_of(text: str) -> list[str]:
    """Sentences of a licence text in the form of ``lines_and_sentences``."""
    found = (re.sub(NOISE, " ", s).strip() for s in re.split(SENTENCE_END, text.lower()))
    return [s for s in found if s]


def known_sentences(sentences: dict[str, str]) -> dict[str, str]:
    """Identifier (``id/k``) by normal sentence: every sentence of every text has one, and a sentence that
    several texts share has that of the first."""
    known: dict[str, str] = {}
    for sid, text in sentences.items():
        for k, part in enumerate(parts_of(text)):
            known.setdefault(part, f"{sid}/{k}")
    return known


def rule_parts(ids: list[str], sentences: dict[str, str]) -> list[str]:
    """The sentence identifiers that a rule names, in order."""
    known, out = known_sentences(sentences), []
    for name in ids:
        sid, _, k = name.partition("/")
        parts = parts_of(sentences[sid])
        out += [known[p] for p in ([parts[int(k)]] if k else parts)]
    return out


def known_pieces(spark: SparkSession, sentences: dict[str, str]) -> DataFrame:
    """``piece``: every run of words of a known sentence, once; ``begins``: the known sentences (``sentence``, ``sid``)
    that it begins. As many rows as the licence texts have runs of words."""
    begins: dict[str, list] = {}
    for sentence, sid in known_sentences(sentences).items():
        words = sentence.split()
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                of = begins.setdefault(" ".join(words[i:j]), [])
                if i == 0:
                    of.append((sentence, sid))
    return spark.createDataFrame(list(begins.items()), "piece string, begins array<struct<sentence:string,sid:string>>")


def _hits(lines: DataFrame, most: int) -> DataFrame:
    """row, pos, last, sid: the known sentences that begin at a line, the longest of each and none inside another.
    ``lines`` are runs of words of known sentences; ``most`` words are in the longest one."""
    in_order = W.partitionBy("row").orderBy("pos")
    parted = F.col("hard") | F.coalesce(F.lag("pos").over(in_order) < F.col("pos") - 1, F.lit(True))
    block = W.partitionBy("row", "block").orderBy("pos")
    ahead = block.rowsBetween(0, most - 1)
    joined = (
        lines.withColumn("parted", parted.cast("int")).withColumn("block", F.sum("parted").over(in_order))
        .withColumn("end", F.sum(F.col("n") + 1).over(block))
        .withColumns({"text": F.concat(F.array_join(F.collect_list("piece").over(ahead), " "), F.lit(" ")), "ends": F.collect_list("end").over(ahead)})
        .filter(F.size("begins") > 0))
    last = lambda k: F.array_position(  # noqa: E731, lines that the sentence takes, 0 if it ends within one
        "ends", F.col("end") - F.col("n") + F.length(k["sentence"]))
    whole = F.filter("begins", lambda k: F.startswith(F.col("text"), F.concat(k["sentence"], F.lit(" "))) & (last(k) > 0))
    best = F.array_max(F.transform(whole, lambda k: F.struct((F.col("pos") + last(k) - 1).cast("int").alias("last"), k["sid"].alias("sid"))))
    return (
        joined.withColumn("best", best).filter("best is not null").select("row", "pos", "best.last", "best.sid")
        .withColumn("before", F.max("last").over(in_order.rowsBetween(W.unboundedPreceding, -1)))
        .filter("before is null or before < last").drop("before"))


def license_matches(docs: DataFrame, sentences: dict[str, str] = ALL_SENTENCES, rules: list = ALL_RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences, n_known, licenses (distinct, sorted, comma-joined),
    matches (``rule:first:last`` by sentence number from 0, in order, comma-joined).

    A line counts as a sentence of its own in the numbers. A known sentence is found on one line, and over
    neighbouring lines without a sentence end or an empty line between them, so that line wrapping and marks of
    comments do not hide it. At each line the longest known sentence counts, and none inside a longer one; so for
    rules. A null text has no sentences; repeated rows each give a row; other columns are ignored.
    """
    spark = docs.sparkSession
    rules = [(name, licence, rule_parts(ids, sentences)) for name, licence, ids in rules]
    longest = max(len(ids) for _, _, ids in rules)
    known = F.broadcast(known_pieces(spark, sentences))
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.concat(F.array(F.lit("")), F.coalesce(lines_and_sentences(F.col("text")), F.array())).alias("all"))
    # one pass over the texts: position 0 stands for the document, sentence i is at i + 1
    found = cut_lineage(
        marked.select("row", "doc_id", (F.size("all") - 1).cast("long").alias("n_sentences"), F.posexplode("all").alias("pos", "line"))
        .withColumn("piece", F.ltrim(F.col("line"), F.lit(HARD)))
        .join(known, "piece", "left").filter("pos = 0 or begins is not null")
        .select("row", "doc_id", "n_sentences", (F.col("pos") - 1).alias("pos"), "begins", F.length("piece").alias("n"),
                F.col("piece"), F.col("line").startswith(HARD).alias("hard")))
    in_order = W.partitionBy("row").orderBy("pos")
    hits = cut_lineage(_hits(found.filter("pos >= 0"), max(len(s.split()) for s in known_sentences(sentences))))
    run = [
        F.struct(*[(F.lead(c, i).over(in_order) if i else F.col(c)).alias(to) for c, to in (("sid", "sid"), ("pos", "at"), ("last", "last"))])
        for i in range(longest)]
    starts = hits.select("row", "pos", F.array(*run).alias("run"))
    lengths = F.sequence(F.lit(1), F.lit(longest))
    ids = lambda n: F.transform(F.slice("run", 1, n), lambda x: x["sid"])
    near = lambda n: F.forall(
        F.sequence(F.lit(1), F.lit(longest)),
        lambda i: (i >= n) | (F.element_at("run", i + 1)["at"] - F.element_at("run", i)["last"] <= MAX_GAP + 1))
    candidates = F.filter(lengths, lambda n: F.element_at("run", n)["sid"].isNotNull() & (near(n) if longest > 1 else F.lit(True)))
    by_ids = spark.createDataFrame(
        [(name, licence, ",".join(i), len(i)) for name, licence, i in rules], "rule string, licence string, ids string, n int")
    matched = (
        starts.select("row", "pos", "run", F.explode(candidates).alias("n"))
        .select("row", "pos", F.element_at("run", F.col("n"))["last"].alias("last"), F.concat_ws(",", ids(F.col("n"))).alias("ids"))
        .join(F.broadcast(by_ids), "ids")
        .groupBy("row", "pos").agg(F.max(F.struct("n", "last", "rule", "licence")).alias("m"))
        .withColumn("before", F.max("m.last").over(in_order.rowsBetween(W.unboundedPreceding, -1)))
        .filter(F.col("before").isNull() | (F.col("before") < F.col("m.last"))))
    per_row = matched.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("pos", "m.last", "m.rule"))).alias("list"),
        F.array_sort(F.collect_set("m.licence")).alias("set"))
    n_known = found.filter("pos < 0").select("row", "doc_id", "n_sentences").join(
        hits.groupBy("row").agg(F.count("*").alias("n_known")), "row", "left")
    text = F.transform("list", lambda m: F.concat_ws(":", m["rule"], m["pos"].cast("string"), m["last"].cast("string")))
    return n_known.join(per_row, "row", "left").select(
        "doc_id", "n_sentences", F.coalesce("n_known", F.lit(0)).cast("long").alias("n_known"), F.coalesce(F.concat_ws(",", "set"), F.lit("")).alias("licenses"),
        F.coalesce(F.concat_ws(",", text), F.lit("")).alias("matches"))


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in SENTENCES.items())
    rules = ", ".join(f"({quote(r)}, {quote(lic)}, {quote(','.join(i))}, {len(i)})" for r, lic, i in RULES)
    normal = ("[x FOR x IN [trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) FOR s IN "
              "string_split_regex(regexp_replace(lower({0}), '[.!?:;]+(\\s|$)', chr(10), 'g'), '\\n')] IF x <> '']")
    return f"""
WITH raw(sid, text) AS (VALUES {known}),
rules(rule, licence, ids, n) AS (VALUES {rules}),
known AS (SELECT min(sid) AS sid, ({normal.format('text')})[1] AS sentence FROM raw GROUP BY 2),
d AS (SELECT doc_id, coalesce({normal.format('text')}, []) AS l FROM documents),
s AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS sentence FROM d),
h AS (SELECT doc_id, pos, sid, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM s JOIN known USING (sentence)),
c AS (
  SELECT a.doc_id, a.pos, b.pos AS last,
    (SELECT string_agg(k.sid, ',' ORDER BY k.i) FROM h k WHERE k.doc_id = a.doc_id AND k.i BETWEEN a.i AND b.i) AS ids,
    (SELECT coalesce(max(k.gap), 0) FROM (SELECT doc_id, i, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM h) k
     WHERE k.doc_id = a.doc_id AND k.i > a.i AND k.i <= b.i) AS gap
  FROM h a JOIN h b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {LONGEST - 1}
),
m AS (SELECT doc_id, pos, last, rule, licence FROM c JOIN rules USING (ids) WHERE gap <= {MAX_GAP + 1}
      QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY n DESC) = 1),
kept AS (SELECT * FROM m QUALIFY coalesce(max(last) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) < last),
g AS (SELECT doc_id, string_agg(rule || ':' || pos || ':' || last, ',' ORDER BY pos) AS matches,
             array_to_string(list_sort(list_distinct(list(licence))), ',') AS licenses FROM kept GROUP BY 1)
SELECT d.doc_id, len(d.l) AS n_sentences, (SELECT count(*) FROM h WHERE h.doc_id = d.doc_id) AS n_known,
       coalesce(licenses, '') AS licenses, coalesce(matches, '') AS matches
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""


@register("op7_licenses", sql=_sql())
def op7_licenses(spark, folder):
    return license_matches(table(spark, folder, "documents"))
