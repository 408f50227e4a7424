"""Registered queries of this subpackage: thin digests of each operator's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm import collocations as CO
from screenlake.llm import decontaminate as DC
from screenlake.llm import langid as LI
from screenlake.llm import line_dedup as LD
from screenlake.llm import mixing as MX
from screenlake.llm import order_minhash as OM
from screenlake.llm import paragraph_dedup as PD
from screenlake.llm import periodic_runs as PR
from screenlake.llm import quality_rules as QR
from screenlake.llm import simhash as SH
from screenlake.llm import suffix_dedup as SD
from screenlake.llm import token_pack as TP
from screenlake.llm import toxicity as TX

VOCAB = "word_bpe_49k.json"
VOCAB_SIZE = 49408


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocab_path(name: str = VOCAB) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TX.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MX.taken(MX.mix_plan(table(spark, sf_dir, "documents")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SD.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.line_report(table(spark, sf_dir, "documents"))


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PD.paragraph_report(table(spark, sf_dir, "documents"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return OM.edited_pairs(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = SH.simhash_components(table(spark, sf_dir, "documents"))
    return parts.select("doc_id", SH.fingerprint_hex().alias("fingerprint"), "component_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LI.identify(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TP.token_files(table(spark, sf_dir, "documents"), vocab_path(), VOCAB_SIZE)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = DC.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = DC.span_words()
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        DC.item_digest().alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text of op11: in a tenth of the documents the words from one
    place on repeat the words from there, a third of what is left or less at a time."""
    h = "crc32(cast(doc_id as string))"
    g, n = f"({h} div 10)", "size(w)"
    a = f"cast({g} % {n} as int)"
    p = f"cast(1 + ({n} - {a}) div (3 + {g} % 8) as int)"
    words = "regexp_extract_all(text, r'[^\\x20\\x09-\\x0D]+', 0)"
    text = (f"transform(array({words}), w -> transform(array({a}), a -> transform(array({p}), p -> "
            "array_join(transform(w, (x, i) -> if(i < a, x, get(w, a + (i - a) % p))), ' '))[0])[0])[0]")
    return docs.select("doc_id", F.expr(f"if({h} % 10 = 0 and size({words}) > 0, {text}, text)").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.run_digests(PR.periodic_runs(with_periods(table(spark, sf_dir, "documents"))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CO.collocations(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QR.verdicts(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_mixing, op3_suffix_dedup, op4_line_dedup, op5_paragraph_dedup, op6_order_minhash, op7_simhash,
                                   op8_language, op9_token_files, op10_decontamination, op11_periodic_runs,
                                   op12_collocations, op13_quality_rules)}


# One DuckDB query per operator that SQL can express; see tests/llm for the others.
ORACLE: dict[str, str] = {}

# Words as above, windows as space-joined strings; a hit word is one inside a found window.
ORACLE["op10_decontamination"] = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
items as (select distinct item_id, least(10, len(w)) as size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win
          from b, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(i) where len(w) > 0),
sizes as (select distinct size from items),
found as (select d.doc_id, i, s.size, array_to_string(w[i : i + s.size - 1], ' ') as win
          from d, sizes s, unnest(range(1, len(w) - s.size + 2)) as t(i) where len(w) >= s.size),
hits as (select f.doc_id, f.i, f.size, x.item_id from found f join items x on f.win = x.win and f.size = x.size),
hit_words as (select doc_id, count(distinct k) as n_hit from hits, unnest(range(i, i + size)) as t(k) group by doc_id),
hit_items as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
              from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""

# Words, lines and three-word windows as rows; the threshold table in whole numbers.
_STOP = ", ".join(f"'{w}', '{w.capitalize()}'" for w in QR.STOP_WORDS)
_BROKEN = ", ".join("case when " + " or ".join([f"1000 * {r.part} < {r.least} * {r.whole}"] * (r.least is not None) + [f"1000 * {r.part} > {r.most} * {r.whole}"] * (r.most is not None))
                    + f" then '{r.name}' end" for r in QR.BASE + QR.RULES)
ORACLE["op13_quality_rules"] = rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
             [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls from d),
win as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from w, unnest(range(1, len(w) - 1)) as t(i)),
again as (select doc_id, i from win qualify count(*) over (partition by doc_id, a, b, c) > 1),
rep as (select doc_id, count(distinct k) as n from again, unnest(range(i, i + 3)) as t(k) group by doc_id),
m as (select w.doc_id, len(w)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
             len([x for x in w if x in ({_STOP})])::bigint as n_stop_words,
             len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
             len([x for x in ls if regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')])::bigint as n_bullet_lines,
             len([x for x in ls if regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')])::bigint as n_cut_lines,
             coalesce(rep.n, 0)::bigint as n_repeat_words
      from w left join rep on w.doc_id = rep.doc_id),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, concat_ws(',', {_BROKEN}) as broken from m)
select *, broken = '' as kept from v
"""

# Phrases as lists of words; a candidate goes if a longer candidate around it is as frequent.
ORACLE["op12_collocations"] = r"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
f as (select lang, w[i : i + k - 1] as p, count(*) as a from w, unnest([1, 2, 3, 4, 5]) as s(k), unnest(range(1, len(w) - k + 2)) as t(i) group by all),
n as (select lang, sum(a)::bigint as n from f where len(p) = 1 group by lang),
c as (select * from f where len(p) > 1 and a >= 100),
inner_parts as (select lang, a, p[i : j] as p from c, unnest(range(1, len(p))) as s(i), unnest(range(i + 1, len(p) + 1)) as t(j) where j - i + 1 < len(p)),
own as (select c.* from c anti join inner_parts i on c.lang = i.lang and c.p = i.p and 100 * i.a >= 100 * c.a),
cuts as (select o.lang, o.p, o.a, k, x.a as l, y.a as r, n.n, (1000::hugeint * o.a * n.n) // (x.a::hugeint * y.a) as score
         from own o join n on o.lang = n.lang, unnest(range(1, len(o.p))) as s(k)
         join f x on x.lang = o.lang and x.p = o.p[1 : k] join f y on y.lang = o.lang and y.p = o.p[k + 1 :]),
best as (select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1),
top as (select *, array_to_string(p, ' ') as phrase, row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank from best)
select lang, rank, phrase, a, l, r, n, score::bigint as score from top where rank <= 2000
"""
