"""Registered queries of the operators: ``QUERIES`` (name -> callable) and ``ORACLE_SQL`` (DuckDB SQL).

Each query applies its operator to the whole of its table and derives the
digest columns of its contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hard_negatives, ngram, ordinal, packing, pii, quality_rules, runs, simhash, substring, topk, toxicity, urls, winnow
from .common import fold, map_arrow
from .words import SPACE_WORDS, slices, split_words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from folds 1 to 4 of 5; fold 0 is held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens; shares as in the corpus."""
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), window=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "queue")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 13 words."""
    judged = winnow.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    return judged.select(
        "doc_id", F.col("overlap.n_words").alias("n_words"), winnow.n_hit().alias("n_hit"),
        F.size("overlap.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("overlap.items")), 256).alias("items_sha256"),
        winnow.contaminated().alias("contaminated"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["strict"])

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["strict"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("email", "ip", "card", "phone")), F.sha2(pii.digest(base), 256).alias("base_sha256"),
                        pii.digest(F.col("spans")).alias("spans"))


def op5_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 low quality; else 1 toxic, 2 not.  Folds 1 to 4 of 5 train; documents of grade 1 or more are selected."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    model = ordinal.fit(docs, labels.where("quality is not null").select("doc_id", grade.alias("rating")))
    return ordinal.score(docs.select("doc_id", "text"), model, wanted=1).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("quality.expected_grade").alias("expected_grade"),
        F.col("quality.tail").alias("tail"), (F.col("quality.tail") >= 0.5).alias("kept"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words."""
    out = substring.deduplicate(table(spark, sf_dir, "documents"), window=20)
    removed = F.aggregate("repeats", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    failed = quality_rules.base_failed()
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & ~F.col("outlier")).alias("kept"), "distance")


#: the rules of the contract (fixed values), and globs for the URLs that they leave open
SITE_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
OPEN_RULES = (urls.Rule("*spam-farm*", "block", rank=30), urls.Rule("*casino*", "block", rank=20),
              urls.Rule("*/wp-login*", "block", rank=10), urls.Rule("*/cgi-bin/*", "block", rank=10))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest fitting site rule wins; URLs that none fits are left to the open rules."""
    rules = [*OPEN_RULES, *(r for verdict, name in SITE_RULES for r in urls.site_rule(verdict, name))]
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", *(F.col(f"site.{c}").alias(c) for c in ("host", "path", "rule", "verdict")))


def op9_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on nine tenths of the documents, all scored."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 10) == 0
    return ngram.score(docs, ngram.fit(docs.where(~held_out)), held_out)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of 3 words, links at 2 or fewer differing bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return out.select("doc_id", simhash.hex64().alias("fingerprint"), "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: ids divisible by 100; labels of ids divisible by 7 move up by one."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256)


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: ids divisible by 20, against all rows."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def with_periods(docs: DataFrame) -> DataFrame:
    """Texts (doc_id, text) in which a tenth, by crc32 of the id, repeats its words from some place on with one period."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

    def run(batches):
        for b in slices(batches, "text"):
            w = split_words(b.column("text"), SPACE_WORDS)
            data, starts, _ = w.normal()
            starts = np.append(starts, len(data))
            out, h = b.column("text").to_pylist(), b.column("h").to_numpy()
            for d in np.flatnonzero((h % 10 == 0) & (w.counts > 0)).tolist():
                n, g, words = int(w.counts[d]), int(h[d]) // 10, starts[w.first[d]: w.first[d + 1] + 1].tolist()
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                once = data[words[a]: words[a + p]].tobytes() if a + p <= n else data[words[a]: words[n]].tobytes()
                times, rest = divmod(n - a, p)
                text = data[words[0]: words[a]].tobytes() + once * times + data[words[a]: words[a + rest]].tobytes()
                out[d] = text.decode()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text", h.alias("h")), run, f"doc_id {kind}, text string")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 24 words and three periods at least."""
    out = runs.collapse(with_periods(table(spark, sf_dir, "documents")), min_length=24, min_exponent=3)
    greater = lambda a, x: x["length"].cast("long") * a["period"] > a["length"].cast("long") * x["period"]
    # runs stand by start and period, so the first of the greatest is the one asked for
    top = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, x: F.when(greater(a, x), x).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    return (out.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"top.{c}").cast("long").alias(c)
                                                                for c in ("start", "length", "period")),
        F.expr("(1000L * top.length) div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_decontaminate": op3_decontaminate,
    "op4_pii": op4_pii,
    "op5_ordinal": op5_ordinal,
    "op6_substring": op6_substring,
    "op7_quality_rules": op7_quality_rules,
    "op8_urls": op8_urls,
    "op9_ngram": op9_ngram,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_topk": op12_topk,
    "op13_runs": op13_runs,
}

_HOST_PATH = """
    with rest as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r
                  from pages),
    hp as (select page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') as host,
                  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest)"""


def _site_sql() -> str:
    """Rules by suffix of the host and start of the path, longest first; then the open rules."""
    cases = []
    for verdict, name in sorted(SITE_RULES, key=lambda r: -len(r[1])):
        host, path = name.split("/", 1)
        cases.append((f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}')", name, verdict))
    rule = " ".join(f"when {c} then '{n}'" for c, n, _ in cases)
    verdict = " ".join(f"when {c} then '{v}'" for c, _, v in cases)
    return f"""{_HOST_PATH}
    select page_id, host, path, case {rule} end as rule,
           case {verdict} when regexp_matches(host, 'spam-farm|casino') or starts_with(path, '/wp-login')
                or starts_with(path, '/cgi-bin/') then 'block' else 'allow' end as verdict
    from hp"""


def _vectors_sql(scale: int, label: str) -> str:
    """Rows (vec_id, label, e) of the embeddings that take part, as lists of whole doubles."""
    return f"""select vec_id, label, list_transform(embedding, lambda x: floor({scale} * cast(x as double))) as e
      from (select vec_id, embedding, {label} as label from embeddings)
      where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""


_DOT = "cast(list_inner_product(q.e, c.e) as bigint)"

_TOPK_SQL = f"""
    with v as ({_vectors_sql(64, "0")}),
    s as (select q.vec_id as query_id, c.vec_id, {_DOT} as score from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
    select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 20"""

_NEGATIVES_SQL = f"""
    with v as ({_vectors_sql(256, "case when vec_id % 7 = 0 then (label + 1) % 10 else label end")}),
    s as (select q.vec_id as anchor_id, c.vec_id, q.label = c.label as alike, {_DOT} as score
          from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 100 = 0),
    p as (select * from s where alike qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
    n as (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
                 row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
          from p join s on s.anchor_id = p.anchor_id and not s.alike
               and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
    select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 10"""

# --- words and windows of texts, as lists and joins

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Every window of an item (the whole item if it has fewer words), joined with the documents' stretches of as many words.
_OVERLAP_SQL = f"""
    with d as (select doc_id, {_ITEM_WORDS} as w from documents),
    b as (select item_id, w, least(13, len(w)) as k from (select item_id, {_ITEM_WORDS} as w from benchmark) where len(w) > 0),
    bw as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as s
           from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from b)),
    dw as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as s
           from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i
                 from d, (select distinct k from bw) where len(w) >= k)),
    hit as (select distinct doc_id, k, i, item_id from dw join bw using (k, s)),
    n as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + k)) as p from hit) group by doc_id),
    items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as names
              from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
           sha256(coalesce(names, '')) as items_sha256, coalesce(n.n, 0) > 0 and 20 * coalesce(n.n, 0) >= len(w) as contaminated
    from d left join n using (doc_id) left join items using (doc_id)"""

# Windows by their words; all but the first of the same words remove what they cover.
_REPEATS_SQL = f"""
    with d as (select doc_id, {_TEXT_WORDS} as w from documents),
    win as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as s
            from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20)),
    later as (select doc_id, i from win qualify row_number() over (partition by s order by doc_id, i) > 1),
    gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from later),
    n as (select doc_id, count(*) as n from gone group by doc_id),
    word as (select doc_id, generate_subscripts(w, 1) as p, unnest(w) as x from d),
    kept as (select doc_id, string_agg(x, ' ' order by p) as t from word anti join gone using (doc_id, p) group by doc_id)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n.n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
    from d left join n using (doc_id) left join kept using (doc_id)"""

# crc32 of the id's digits, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''),
           lambda c: cast(ascii(c) as bigint))), lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""

# Equal words at every distance; unbroken stretches of them, but for those inside one of a smaller distance, are the runs.
_RUNS_SQL = f"""
    with d as (select doc_id, {_TEXT_WORDS} as w, {_CRC32} as h from documents),
    place as (select *, h // 10 as g, cast(len(w) as bigint) as n, (h // 10) % greatest(len(w), 1) as a from d),
    bent as (select doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n),
                 lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) else w end as w from place),
    word as (select doc_id, n, generate_subscripts(w, 1) - 1 as i, unnest(w) as x from bent),
    alike as (select l.doc_id, r.i - l.i as q, l.i from word l join word r on l.doc_id = r.doc_id and l.x = r.x and r.i > l.i
              where 3 * (r.i - l.i) <= l.n),
    part as (select *, i - row_number() over (partition by doc_id, q order by i) as z from alike),
    stretch as (select doc_id, q, min(i) as s, count(*) + q as m from part group by doc_id, q, z
                having count(*) + q >= greatest(24, 3 * q)),
    run as (select * from stretch c where not exists (select 1 from stretch o where o.doc_id = c.doc_id and o.q < c.q
                and o.s <= c.s and o.s + o.m >= c.s + c.m)),
    told as (select doc_id, count(*) as n_runs, string_agg(concat(s, ',', m, ',', q, chr(10)), '' order by s, q) as t
             from run group by doc_id),
    top as (select doc_id, s, m, q from run qualify row_number() over (partition by doc_id order by m / q desc, s, q) = 1),
    gone as (select distinct doc_id, unnest(range(s + q, s + m)) as i from run),
    kept as (select doc_id, string_agg(x, ' ' order by i) as c from word anti join gone using (doc_id, i) group by doc_id)
    select doc_id, coalesce(n_runs, 0) as n_runs, s as start, m as length, q as period, 1000 * m // q as exponent_milli,
           sha256(coalesce(t, '')) as runs_sha256, sha256(coalesce(c, '')) as collapsed_sha256
    from d left join told using (doc_id) left join top using (doc_id) left join kept using (doc_id)"""


ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": _OVERLAP_SQL,
    "op6_substring": _REPEATS_SQL,
    "op8_urls": _site_sql(),
    "op11_hard_negatives": _NEGATIVES_SQL,
    "op12_topk": _TOPK_SQL,
    "op13_runs": _RUNS_SQL,
}
