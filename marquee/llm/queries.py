"""Registered queries of this subpackage: thin views of the operators' outputs.

Each query applies one operator, with production parameters, to its whole
table and derives the contract's digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import workspace_dir

from . import (bpe, decontam, embed_dedup, html_blocks, langid, licenses, merkle, ngram_join, repair, secrets,
               suffix_dedup, token_orc, toxicity)
from .common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = bpe.encode(docs, decoded="decoded")
    return got.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return got.select("doc_id", "held_out", "lang_pred", "score")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
                      F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("findings", lambda f: f["base"])
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")
    return got.select("doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                      F.sha2(secrets.described(base), 256).alias("base_sha256"),
                      secrets.described(F.col("findings")).alias("spans"))


def op5_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html_blocks.extract(table(spark, sf_dir, "pages"))
    return got.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = toxicity.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "p_low_quality", "low_quality", "p_toxic", "toxic")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    listed = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return got.select("doc_id", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"),
                      F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"), "contaminated")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace_dir(spark) + "/tokens"
    token_orc.write(table(spark, sf_dir, "documents"), path)
    got = token_orc.read(spark, path)
    return got.select("doc_id", "start", "n_tokens", token_orc.ids_crc32(F.col("ids")).alias("ids_crc32"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the contract's damage, by a checksum of their conversation and turn."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"),
                                code.alias("code")).filter("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(
                           F.array(F.lit(1)))).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    got = repair.repair(damaged(conversations))
    # Conversations that lost all their rows are listed as well.
    ids = conversations.select("conv_id").distinct()
    met = ids.join(got.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return met.select("conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Tampering adds 1 to n_chars; wide enough for the largest value.
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    values = [more if c == "n_chars" else F.col(c) for c in merkle.LEAF_COLUMNS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(docs, carry={"shown": F.when(tampered, merkle.leaf_digest(values))})
    proved = got.withColumn("folded_root", merkle.folded(F.coalesce("shown", "leaf"), F.col("path")))
    return proved.select("doc_id", "leaf", "subroot", "root",
                         F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = licenses.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    word = F.transform("places", lambda p: p["word"])
    return got.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
                      F.array_min(word).alias("first_word"), F.array_max(word).alias("last_word"),
                      licenses.labels(F.col("places")).alias("base_labels"),
                      licenses.labels(F.col("places"), F.filter("blocks", lambda b: b["closest"])).alias("labels"),
                      licenses.score(F.col("places"), F.col("blocks")).alias("score"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_language_id": op2_language_id,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_html_blocks": op5_html_blocks,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_token_orc": op10_token_orc,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_license_scan": op13_license_scan,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _templates() -> str:
    """The license templates as SQL rows (kind, label, words)."""
    known = licenses.Templates()
    return ", ".join(f"('{kind}', '{label}', {[w.decode() for w in sorted(words)]})"
                     for kind, label, words in zip(known.kind, known.label, known.words, strict=True))


def _phrases() -> str:
    return ", ".join(f"('{label}', {[w.decode() for w in words]})" for words, label in licenses.Templates().phrases)


_WORDS = "list_filter(string_split_regex({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

#: CRC-32 in SQL: the remainders of the 256 bytes, and the checksum of a text of ASCII characters.
_CRC_TABLE = """
crc_table as (
  select list(v order by i) remainders from (
    select range i, list_reduce(list_prepend(range, range(8)), lambda c, k:
      case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) v from range(256)))"""


def _crc32(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)), "
            "lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(concat(" + ", ".join(_field(n_chars if c == "n_chars" else c) for c in merkle.LEAF_COLUMNS) + "))"


def _least(*routes: str) -> str:
    return f"(list_sort([{', '.join(routes)}]))[1]"


def _route(state: str, cost: str, letter: str, put: str = "''", only: str = "true") -> str:
    """A state's cost, audit and repaired text after an edit; out of reach where it isn't allowed."""
    return (f"{{'c': {state}.c + {cost} + case when {only} then 0 else 1000000 end, 'a': {state}.a || '{letter}', "
            f"'r': {state}.r || {put}}}")


def _walk(table: str) -> str:
    """States n (nothing yet), s, u, a with the inserts that may follow them."""
    put = lambda role: f"chr(10) || '{role}:'"
    ins = lambda q, role: _route(q, "3", "I", put(role))
    return (f"select *, {_least('a', ins('u', 'assistant'))} a_in from (select * replace ("
            f"{_least('u', *[ins(q, 'user') for q in 'nsa'])} as u) from {table})")


def _step() -> str:
    """The states behind one more row."""
    own = "chr(10) || role || ':' || text"
    extra = "case when fault = 't' then 3 else 0 end"
    keeps = "fault in ('', 't')"
    keep = lambda q, x: _route(q, extra, "K", own, f"{keeps} and initial = '{x}'")
    role = lambda q, r: _route(q, f"3 + {extra}", "R", f"chr(10) || '{r}:' || text", keeps)
    gone = lambda q: _route(q, "4", "D")
    return ", ".join([
        f"{_least(gone('n'))} n", f"{_least(gone('s'), keep('n', 's'))} s",
        f"{_least(gone('u'), *[f(q, x) for q in ('n', 's', 'a_in') for f, x in ((keep, 'u'), (role, 'user'))])} u",
        f"{_least(gone('a_in'), keep('u', 'a'), role('u', 'assistant'))} a"])


_NO_ROUTE = "{'c': 1000000, 'a': '', 'r': ''}"

#: Stated in SQL where it can express the operator; the others have brute-force tests.
ORACLE: dict[str, str] = {
    "op6_embedding_dedup": """
with recursive fit as (
  select vec_id, label, embedding::double[] v from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select a.vec_id x, b.vec_id y from fit a join fit b
    on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
reach as (select vec_id x, vec_id y from embeddings union select r.x, p.y from reach r join pairs p on r.y = p.x)
select e.vec_id, (select count(*) from pairs p where p.x = e.vec_id) n_links, min(r.y) component_id,
       e.vec_id = min(r.y) kept
from embeddings e join reach r on r.x = e.vec_id group by e.vec_id""",
    "op8_decontamination": f"""
with own as (
  select doc_id, list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') w from documents),
item as (
  select item_id, list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') w from benchmark),
wanted as (
  select distinct item_id, least(len(w), 10) n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') run
  from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) i from item where len(w) > 0)),
there as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') run
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from own, (select distinct n from wanted) where len(w) >= n)),
hit as (select doc_id, i, n, item_id from there join wanted using (n, run)),
words as (select doc_id, count(distinct k) n_hit from (select doc_id, unnest(range(i, i + n)) k from hit) group by doc_id),
items as (
  select doc_id, count(*) n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) ids
  from (select distinct doc_id, item_id from hit) group by doc_id)
select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from own left join words using (doc_id) left join items using (doc_id)""",
    "op9_ngram_jaccard": f"""
with recursive own as (
  select doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
sets as (
  select distinct doc_id, array_to_string(w[i:i + 2], ' ') run
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) i from own where len(w) > 0)),
sizes as (select doc_id, count(*) n from sets group by doc_id),
common as (
  select a.doc_id x, b.doc_id y, count(*) c from sets a join sets b on a.run = b.run and a.doc_id < b.doc_id group by all),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 90 * (p.n + q.n - c)),
edge as (select x, y from links union all select y, x from links),
reach as (select doc_id x, doc_id y from documents union select r.x, b.y from reach r join edge b on r.y = b.x)
select d.doc_id, coalesce(any_value(n), 0) n_shingles, min(r.y) component_id
from documents d join reach r on r.x = d.doc_id left join sizes s on s.doc_id = d.doc_id group by d.doc_id""",
    "op12_merkle_manifest": f"""
with recursive {_CRC_TABLE},
leaves as (
  select doc_id, lang, {_leaf("n_chars")} leaf,
         case when {_crc32("doc_id::varchar")} % 7 = 0 then {_leaf("(n_chars::hugeint + 1)")} end shown
  from documents, crc_table),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 place from leaves),
tree as (
  select lang, 0 lvl, place, leaf h from placed
  union all
  select lang, lvl + 1, place // 2, sha256(string_agg(h, '' order by place))
  from (select *, count(*) over (partition by lang) nodes from tree) where nodes > 1 group by lang, lvl, place // 2),
subroots as (select lang, max(lvl) height, arg_max(h, lvl) subroot from tree group by lang),
ordered as (select *, row_number() over (order by lang nulls first) - 1 sub_place from subroots),
top as (
  select 0 lvl, sub_place place, subroot h from ordered
  union all
  select lvl + 1, place // 2, sha256(string_agg(h, '' order by place))
  from (select *, count(*) over () nodes from top) where nodes > 1 group by lvl, place // 2),
root as (select max(lvl) root_height, arg_max(h, lvl) root from top),
steps as (
  select p.doc_id, p.leaf, p.place, p.lang, s.lvl, (p.place >> s.lvl) & 1 slot, t.h
  from placed p join (select lang, unnest(range(height)) lvl from ordered) s on p.lang is not distinct from s.lang
  left join tree t on t.lang is not distinct from p.lang and t.lvl = s.lvl and t.place = xor(p.place >> s.lvl, 1)
  union all
  select p.doc_id, p.leaf, p.place, p.lang, 1000 + s.lvl, (o.sub_place >> s.lvl) & 1, t.h
  from placed p join ordered o on p.lang is not distinct from o.lang,
       (select unnest(range(root_height)) lvl from root) s
  left join top t on t.lvl = s.lvl and t.place = xor(o.sub_place >> s.lvl, 1)),
paths as (
  select lang, place, coalesce(string_agg(h, '' order by lvl), '') siblings,
         list(case when h is null then '' when slot = 1 then 'l' || h else 'r' || h end order by lvl) path
  from steps group by lang, place),
proved as (
  select p.*, subroot, root, coalesce(siblings, '') siblings,
    list_reduce(list_prepend(coalesce(shown, leaf), coalesce(path, []::varchar[])), lambda h, s: sha256(
      case when s[1] = 'l' then s[2:] || h when s[1] = 'r' then h || s[2:] else h end)) folded_root
  from placed p join ordered o on p.lang is not distinct from o.lang, root
  left join paths q on q.lang is not distinct from p.lang and q.place = p.place)
select doc_id, leaf, subroot, root, sha256(siblings) proof_sha256, folded_root, folded_root = root verified from proved""",
    "op13_license_scan": f"""
with own as (select doc_id, {_LOWER} t, {_WORDS.format(_LOWER)} w from documents),
phrase(label, p) as (values {_phrases()}),
place as (
  select doc_id, label, i - 1 word from (select doc_id, w, unnest(range(1, len(w) + 1)) i from own), phrase
  where w[i] = p[1] and w[i:i + len(p) - 1] = p),
base as (
  select doc_id, count(*) n_base, min(word) first_word, max(word) last_word, list(distinct label) labels
  from place group by doc_id),
template(kind, label, t) as (values {_templates()}),
line as (
  select doc_id, i, {_WORDS.format("part")} w
  from (select doc_id, unnest(string_split(t, chr(10))) part, unnest(range(len(string_split(t, chr(10))))) i from own)),
cut as (select *, count(*) filter (len(w) = 0) over (partition by doc_id order by i) no from line),
block as (
  select doc_id, 'line' kind, i, list_distinct(w) w from line where len(w) > 0
  union all
  select doc_id, 'paragraph', min(i), list_distinct(flatten(list(w))) from cut where len(w) > 0 group by doc_id, no),
held as (
  select *, shared / size share, max(shared / size) over (partition by doc_id, kind, i) best from (
    select doc_id, b.kind, i, label, len(list_intersect(w, t)) shared, len(t) size
    from block b join template t on b.kind = t.kind)
  where shared * {licenses.DEN} >= {licenses.NUM} * size),
closest as (
  select *, max(size) over (partition by doc_id, kind, i) longest from held where share = best),
method as (
  select doc_id, list(distinct label) labels, max(share) score from closest where size = longest group by doc_id)
select doc_id, len(w) n_words, coalesce(n_base, 0) n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, m.labels))), ','), '') labels,
       case when n_base > 0 then 1.0 else coalesce(score, 0.0) end score
from own left join base b using (doc_id) left join method m using (doc_id)""",
    "op11_conversation_repair": f"""
with recursive {_CRC_TABLE},
raw as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
         {_crc32("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 code
  from conversations, crc_table),
damaged as (
  select conv_id, turn, case when code = 4 then 'user' else role end role,
         case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text
  from raw, (select unnest(range(2)) copy) where code <> 0 and (copy = 0 or code = 3)),
numbered as (
  select *, row_number() over (partition by conv_id, role, text order by i) copy from (
    select *, left(role, 1) initial, row_number() over (partition by conv_id order by turn nulls first, role, text) i
    from damaged)),
faulty as (
  select *, lag(initial) over (partition by conv_id order by i) || initial pair,
         case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'b' when copy > 1 then 'd'
              when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 't' else '' end fault from numbered),
stats as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (fault = 'b') blank,
         count(*) filter (fault = 'd') duplicate, count(*) filter (fault = 't') truncated,
         count(*) filter (pair not in ('su', 'ua', 'au')) illegal, max(i) rows
  from faulty group by conv_id),
walk as (
  select conv_id, 0::bigint i, {{'c': 0, 'a': '', 'r': ''}} n, {_NO_ROUTE} s, {_NO_ROUTE} u, {_NO_ROUTE} a from stats
  union all
  select w.conv_id, r.i, {_step()}
  from ({_walk("walk")}) w join faulty r on w.conv_id is not distinct from r.conv_id and r.i = w.i + 1),
done as (
  select w.conv_id, {_least("n", "a_in")} best
  from ({_walk("walk")}) w join stats t on w.conv_id is not distinct from t.conv_id and w.i = t.rows),
ids as (select distinct conv_id from conversations)
select ids.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate,
       coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, coalesce(best.c, 0) cost, coalesce(best.a, '') audit,
       sha256(coalesce(best.r[2:], '')) repaired_sha256
from ids left join stats on stats.conv_id is not distinct from ids.conv_id
left join done on done.conv_id is not distinct from ids.conv_id""",
}
