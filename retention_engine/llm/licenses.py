"""License scan with ordered signature rules, in DataFrame functions alone.

A rule is a regular expression over a text's words (A-Z lower-cased, one space between words) that begins at its
keyword, a literal word. Texts without any gate word (every rule has one of those) are passed by after substring
tests. In the others each place of a keyword is an anchor; the words from there on (as many as the longest rule can
span), if they have a gate word, are matched against the rules of that keyword only. A match is an interval of words
with the rule's priority. Equal intervals keep the rule of highest priority, then the first in order. An interval
inside another of equal or higher priority is suppressed: "mit license" inside "licensed under the mit license" is
one detection, not two.

Base rules are the plain phrases every scan counts. All their places count for ``n_base``, ``first_word``,
``last_word`` and ``base_labels``, suppressed or not; ``labels`` has the base labels and those of every detection that
was not suppressed. ``score`` is the highest confidence among the detections kept, 0 without any.

The rules are written by family below: a name's spellings, then the contexts a license is named in. The table has a
fixed size (some hundreds of short rows), so it is broadcast.

Nulls and edge cases: a null or empty text has no words and no detections; a null id is a row like any other; rows
that repeat are scanned each for itself; an empty table gives an empty result; other columns are ignored. Detections
of one text are gathered per text, never per label or rule.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything that is not in a word, before A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Every match of a rule holds one of these (in words with a space before, between and behind).
GATES = [" licen", " gnu ", " gpl", " lgpl", " agpl", " gfdl ", " cc by ", " cc0", " cc zero ", " creative commons ", " mpl ", " epl ",
         " cddl ", " cpl ", " eupl ", " ofl ", " upl ", " odbl ", " odc by ", " pddl ", " bsd ", " unlicense ", " wtfpl ", " openrail ",
         " rights reserved ", " proprietary ", " public domain ", " terms of use ", " spdx "]
#: No rule spans more words than this.
SPAN = 20

BASE = [("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license")]

V = r"(?: (?:version|v|ver))?"

#: label, spellings of the name as regular expressions over words. The first word of each spelling is literal.
NAMES: list[tuple[str, list[str]]] = [
    ("gpl-1.0", [rf"gnu general public license{V} 1(?: 0)?", rf"gpl{V} 1(?: 0)?", "gplv1"]),
    ("gpl-2.0", [rf"gnu general public license{V} 2(?: 0)?", rf"gnu gpl{V} 2(?: 0)?", rf"gpl{V} 2(?: 0)?", "gplv2", "gpl2"]),
    ("gpl-3.0", [rf"gnu general public license{V} 3(?: 0)?", rf"gnu gpl{V} 3(?: 0)?", rf"gpl{V} 3(?: 0)?", "gplv3", "gpl3"]),
    ("gpl", ["gnu general public licen[sc]e", "gnu gpl", "gnu public license", "gpl license"]),
    ("lgpl-2.0", [rf"gnu library general public license{V} 2(?: 0)?", rf"lgpl{V} 2 0", "lgplv2"]),
    ("lgpl-2.1", [rf"gnu lesser general public license{V} 2 1", rf"lgpl{V} 2 1", "lgplv2 1"]),
    ("lgpl-3.0", [rf"gnu lesser general public license{V} 3(?: 0)?", rf"lgpl{V} 3(?: 0)?", "lgplv3"]),
    ("lgpl", ["gnu (?:lesser|library) general public license", "gnu lgpl", "lgpl license"]),
    ("agpl-3.0", [rf"gnu affero general public license{V} 3(?: 0)?", rf"affero general public license{V} 3(?: 0)?",
                  rf"agpl{V} 3(?: 0)?", "agplv3"]),
    ("agpl", ["gnu affero general public license", "affero general public license", "gnu agpl", "agpl license"]),
    ("gfdl-1.2", [rf"gnu free documentation license{V} 1 2", rf"gfdl{V} 1 2"]),
    ("gfdl-1.3", [rf"gnu free documentation license{V} 1 3", rf"gfdl{V} 1 3"]),
    ("gfdl", ["gnu free documentation license", "gnu fdl", "gfdl license"]),
    ("apache-1.0", [rf"apache (?:software )?license{V} 1 0"]),
    ("apache-1.1", [rf"apache (?:software )?license{V} 1 1"]),
    ("apache-2.0", [rf"apache (?:software )?license{V} 2(?: 0)?", "apache 2(?: 0)? license", "apache license 2(?: 0)?"]),
    ("apache", ["apache (?:software |public )?licen[sc]e"]),
    ("mit", ["mit licen[sc]e", "mit expat license", "expat license"]),
    ("mit-0", ["mit no attribution license", "mit 0 license"]),
    ("x11", ["x11 license", "mit x11 license", "x consortium license"]),
    ("isc", ["isc licen[sc]e", "internet systems consortium license"]),
    ("bsd-0-clause", ["0bsd license", "zero clause bsd license", "bsd zero clause license"]),
    ("bsd-1-clause", ["bsd 1 clause license", "1 clause bsd license"]),
    ("bsd-2-clause", ["bsd 2 clause(?: license)?", "2 clause bsd license", "simplified bsd license", "freebsd license",
                      "two clause bsd license"]),
    ("bsd-3-clause", ["bsd 3 clause(?: license)?", "3 clause bsd license", "new bsd license", "modified bsd license",
                      "revised bsd license", "three clause bsd license"]),
    ("bsd-4-clause", ["bsd 4 clause(?: license)?", "4 clause bsd license", "original bsd license", "four clause bsd license"]),
    ("bsd", ["bsd(?: style)? licen[sc]e", "berkeley software distribution license"]),
    ("mpl-1.0", [rf"mozilla public license{V} 1 0", rf"mpl{V} 1 0"]),
    ("mpl-1.1", [rf"mozilla public license{V} 1 1", rf"mpl{V} 1 1"]),
    ("mpl-2.0", [rf"mozilla public license{V} 2(?: 0)?", rf"mpl{V} 2(?: 0)?"]),
    ("mpl", ["mozilla public licen[sc]e"]),
    ("epl-1.0", [rf"eclipse public license{V} 1(?: 0)?", rf"epl{V} 1 0"]),
    ("epl-2.0", [rf"eclipse public license{V} 2(?: 0)?", rf"epl{V} 2 0"]),
    ("epl", ["eclipse public licen[sc]e", "eclipse distribution license"]),
    ("cddl-1.0", [rf"common development and distribution license{V} 1 0", rf"cddl{V} 1 0"]),
    ("cddl-1.1", [rf"common development and distribution license{V} 1 1", rf"cddl{V} 1 1"]),
    ("cddl", ["common development and distribution license", "cddl license"]),
    ("cpl-1.0", [rf"common public license{V} 1 0", rf"cpl{V} 1 0"]),
    ("cpl", ["common public license"]),
    ("ipl-1.0", [rf"ibm public license{V} 1 0", "ibm public license"]),
    ("eupl-1.1", [rf"european union public licen[sc]e{V} 1 1", rf"eupl{V} 1 1"]),
    ("eupl-1.2", [rf"european union public licen[sc]e{V} 1 2", rf"eupl{V} 1 2"]),
    ("eupl", ["european union public licen[sc]e", "eupl licence"]),
    ("artistic-1.0", [rf"artistic license{V} 1 0"]),
    ("artistic-2.0", [rf"artistic license{V} 2(?: 0)?"]),
    ("artistic", ["artistic license", "perl artistic license"]),
    ("bsl-1.0", [rf"boost software license{V} 1(?: 0)?", "boost software license"]),
    ("busl-1.1", [rf"business source license{V} 1 1", "business source license"]),
    ("sspl-1.0", [rf"server side public license{V} 1", "server side public license"]),
    ("elastic-2.0", [rf"elastic license{V} 2(?: 0)?", "elastic license"]),
    ("zlib", ["zlib license", "zlib libpng license"]),
    ("libpng", ["libpng license", "png reference library license"]),
    ("openssl", ["openssl license", "openssl ssleay license"]),
    ("python-2.0", [rf"python software foundation license{V} 2(?: 0)?", "psf license", "python software foundation license",
                    "python license"]),
    ("php-3.01", [rf"php license{V} 3 01", "php license"]),
    ("ruby", ["ruby license"]),
    ("unlicense", ["unlicense"]),
    ("wtfpl", ["wtfpl"]),
    ("beerware", ["beerware license"]),
    ("json", ["json license"]),
    ("curl", ["curl license"]),
    ("vim", ["vim license"]),
    ("ofl-1.0", [rf"sil open font license{V} 1 0"]),
    ("ofl-1.1", [rf"sil open font license{V} 1 1", rf"ofl{V} 1 1"]),
    ("ofl", ["sil open font license", "open font license"]),
    ("ncsa", ["ncsa license", "university of illinois ncsa open source license"]),
    ("postgresql", ["postgresql license"]),
    ("oracle-upl", ["universal permissive license", "upl 1 0"]),
    ("ms-pl", ["microsoft public license", "ms pl license"]),
    ("ms-rl", ["microsoft reciprocal license", "ms rl license"]),
    ("afl-3.0", [rf"academic free license{V} 3(?: 0)?", "academic free license"]),
    ("osl-3.0", [rf"open software license{V} 3(?: 0)?", "open software license"]),
    ("qpl-1.0", [rf"q public license{V} 1 0", "q public license"]),
    ("sleepycat", ["sleepycat license"]),
    ("w3c", ["w3c license", "w3c software notice and license"]),
    ("unicode", ["unicode license", "unicode terms of use"]),
    ("odbl-1.0", [rf"open database license{V} 1 0", "open database license", "odbl"]),
    ("odc-by-1.0", ["open data commons attribution license", "odc by"]),
    ("pddl-1.0", ["public domain dedication and license", "pddl"]),
    ("cdla-permissive", ["community data license agreement permissive"]),
    ("cdla-sharing", ["community data license agreement sharing"]),
    ("open-government", ["open government licen[sc]e"]),
    ("cc0-1.0", ["cc0(?: 1 0)?(?: universal)?", "cc zero", "creative commons zero"]),
    ("public-domain", ["public domain(?: dedication)?", "released into the public domain"]),
    ("openrail", ["openrail(?: m)?(?: license)?", "responsible ai license"]),
    ("llama", ["llama (?:2|3) community license", "llama community license"]),
    ("proprietary", ["all rights reserved", "proprietary and confidential"]),
]

#: Parts of Creative Commons licenses; every version of every kind becomes a rule.
CC_KINDS = [("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
            ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
            ("by-nc", "by nc", "attribution non ?commercial"), ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s"),
            ("by-sa", "by sa", "attribution share ?alike"), ("by", "by", "attribution")]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

#: Words before a name that make it a grant, with the priority and confidence of the whole.
CONTEXTS = [("licensed under(?: the)?(?: terms of)?(?: the)?", 40, 0.98),
            ("released under(?: the)?(?: terms of)?(?: the)?", 40, 0.97),
            ("distributed under(?: the)?(?: terms of)?(?: the)?", 40, 0.97),
            ("available under(?: the)?(?: terms of)?(?: the)?", 40, 0.95),
            ("spdx license identifier", 50, 1.0)]
NAME_PRIORITY, NAME_CONFIDENCE = 30, 0.9
BASE_PRIORITY, BASE_CONFIDENCE = 20, 0.7


def rules() -> list[tuple[int, str, str, str, int, float, bool]]:
    """(order, keyword, pattern, label, priority, confidence, base) of every rule, in order."""
    names = [(label, p) for label, patterns in NAMES for p in patterns]
    for kind, short, long in CC_KINDS:
        for v in CC_VERSIONS:
            label = f"cc-{kind}-{v.replace(' ', '.')}"
            names.append((label, f"(?:cc {short}|creative commons {long}){V} {v}"))
        names.append((f"cc-{kind}", f"(?:cc {short}|creative commons {long})"))
    out = []
    for context, priority, confidence in CONTEXTS:
        for label, p in names:
            out.append((context.split(" ", 1)[0], f"{context} {p}(?: licen[sc]e)?", label, priority, confidence, False))
    for label, p in names:
        for word in ("cc", "creative") if p.startswith("(?:cc ") else (p.split(" ", 1)[0].split("(", 1)[0],):
            out.append((word, p, label, NAME_PRIORITY, NAME_CONFIDENCE, False))
    for label, p in BASE:
        out.append((p.split(" ", 1)[0], p, label, BASE_PRIORITY, BASE_CONFIDENCE, True))
    return [(i, *r) for i, r in enumerate(out)]


def rule_values() -> str:
    """The rules as rows of a SQL VALUES list; a match may take the space behind it along."""
    return ",\n".join(f"({i}, '{k}', '^(?:{p})(?: |$)', '{label}', {pr}, {c}, {str(b).lower()})"
                      for i, k, p, label, pr, c, b in rules())


RULE_COLUMNS = "rule, keyword, pattern, label, priority, confidence, base"


def _gated(words: Column) -> Column:
    return reduce(lambda a, b: a | b, [words.contains(g) for g in GATES])


def _words_of(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), GAP, " "))


def detections(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row's detections: its columns but the text, and (n_words, word, end, rule, label, priority, confidence,
    base, kept); a row without any has one line of nulls. ``_row`` must tell the rows apart."""
    own = [c for c in rows.columns if c != text_col]
    keywords = sorted({r[1] for r in rules()})
    words = rows.select(*own, _words_of(F.col(text_col)).alias("t"))
    n_words = F.when(F.col("t") == "", 0).otherwise(F.length("t") - F.length(F.replace("t", F.lit(" "), F.lit(""))) + 1)
    # An array is made only of the texts that pass the gate.
    w = F.when(_gated(F.concat(F.lit(" "), F.col("t"), F.lit(" "))), F.split("t", " ", -1))
    places = F.filter(F.transform(F.col("w"), lambda x, i: F.when(x.isin(keywords), F.struct(i.alias("word"), x.alias("keyword")))),
                      lambda p: p.isNotNull())
    anchors = (words.select(*own, n_words.cast("long").alias("n_words"), w.alias("w"))
               .select(*own, "n_words", "w", F.explode_outer(places).alias("p"))
               .select(*own, "n_words", F.col("p.word").alias("word"), F.col("p.keyword").alias("keyword"),
                       F.array_join(F.slice("w", F.col("p.word") + 1, SPAN), " ").alias("ahead")))
    table = F.broadcast(rows.sparkSession.sql(f"SELECT * FROM VALUES {rule_values()} AS t({RULE_COLUMNS})")
                        .withColumn("confidence", F.col("confidence").cast("double")).withColumnRenamed("keyword", "rule_keyword"))
    match = F.expr("rtrim(regexp_extract(ahead, pattern, 0))")
    hits = anchors.join(table, (F.col("keyword") == F.col("rule_keyword")) & _gated(F.concat(F.lit(" "), F.col("ahead"), F.lit(" ")))
                        & F.expr("rlike(ahead, pattern)"), "left")
    end = F.col("word") + 1 + F.length(match) - F.length(F.replace(match, F.lit(" "), F.lit("")))
    hits = hits.select(*own, "n_words", "word", end.alias("end"), "rule", "label", "priority", "confidence", "base")
    same = Window.partitionBy("_row").orderBy("word", F.desc("end"), F.desc("priority"), "rule")
    hits = hits.withColumn("first", ~(F.lag("word").over(same).eqNullSafe(F.col("word")) & F.lag("end").over(same).eqNullSafe(F.col("end"))))
    # Before a row in this order: all intervals that begin no later and, beginning with it, end no earlier.
    before = same.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.lit(False)
    for p in sorted({r[4] for r in rules()}):
        reach = F.max(F.when(F.col("first") & (F.col("priority") >= p), F.col("end"))).over(before)
        inside = inside | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return hits.withColumn("kept", F.col("rule").isNotNull() & F.col("first") & ~inside).drop("first")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections) for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("_row"))
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    on_base = lambda c: F.when(F.col("base"), F.col(c))
    return detections(rows).groupBy("_row", "doc_id", "n_words").agg(
        F.count(on_base("rule")).alias("n_base"), F.min(on_base("word")).cast("long").alias("first_word"),
        F.max(on_base("word")).cast("long").alias("last_word"), names(on_base("label")).alias("base_labels"),
        names(F.when(F.col("base") | F.col("kept"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("kept"), F.col("confidence"))), F.lit(0.0)).alias("score"),
        F.count(F.when(F.col("kept"), 1)).alias("n_detections")).drop("_row")


def oracle() -> str:
    """The scan in DuckDB SQL, over ``documents``."""
    gate = lambda c: "(" + " OR ".join(f"contains(' ' || {c} || ' ', '{g}')" for g in GATES) + ")"
    keywords = ", ".join(f"'{k}'" for k in sorted({r[1] for r in rules()}))
    classes = sorted({r[4] for r in rules()})
    inside = " OR ".join(f"(priority = {p} AND coalesce(max(CASE WHEN f AND priority >= {p} THEN e END) OVER b >= e, false))" for p in classes)
    return f"""
WITH rules({RULE_COLUMNS}) AS (VALUES {rule_values()}),
d AS (SELECT row_number() OVER () AS r, doc_id,
             trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAP}', ' ', 'g')) AS t FROM documents),
w AS (SELECT r, doc_id, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS n_words, string_split(t, ' ') AS w,
             {gate("t")} AS g FROM d),
a AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE g),
k AS (SELECT r, i, array_to_string(w[i:i + {SPAN - 1}], ' ') AS ahead, w[i] AS k FROM a WHERE w[i] IN ({keywords})),
m AS (SELECT r, i - 1 AS s, rtrim(regexp_extract(ahead, pattern)) AS m, rules.* FROM k JOIN rules ON k.k = rules.keyword
      WHERE {gate("ahead")} AND regexp_matches(ahead, pattern)),
h AS (SELECT r, s, s + len(string_split(m, ' ')) AS e, rule, label, priority, confidence::DOUBLE AS confidence, base FROM m),
n AS (SELECT *, row_number() OVER (PARTITION BY r, s, e ORDER BY priority DESC, rule) = 1 AS f FROM h),
x AS (SELECT *, f AND NOT ({inside}) AS kept FROM n
      WINDOW b AS (PARTITION BY r ORDER BY s, e DESC, priority DESC, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
y AS (SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept) AS labels,
             max(confidence) FILTER (kept) AS score, count(*) FILTER (kept) AS n_detections FROM x GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score,
       coalesce(n_detections, 0) AS n_detections
FROM w LEFT JOIN y USING (r)
"""
