"""The registered queries of the operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import work_dir

from . import decontam, langid, lcp, linededup, mixing, ppm, prefixtrie, quality, simhash, superkmers, urlfilter, variants, warc
from .common import id_remainder, stored, table

WARC_MIN_BYTES = 0
SIMHASH = {"words": 3, "radius": 3, "segments": 2, "seed": 42}
QUALITY_TRAIN_ROWS = 2000
QUALITY_CUT = 0.3


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, out = work_dir(spark, "arc"), work_dir(spark, "warc")
    warc.write_arc(table(spark, sf_dir, "pages"), arc)
    warc.convert(spark, arc, out, WARC_MIN_BYTES)
    read = stored(warc.read_warc(spark, out), "warc_read")
    kept = read.where("record_type = 'response'").groupBy(F.col("record_id").alias("kept_id")).agg(F.max("source_id").alias("refers_to"))
    return read.join(kept, F.col("refers_to_id") == F.col("kept_id"), "left").select(
        F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), **SIMHASH)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    model = langid.learn(docs, ~held_out)
    return langid.identify(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.contaminated(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), ["doc_id"])


def op5_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("row")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = linededup.with_bitmaps(docs, min_docs=linededup.MIN_DOCS, min_chars=linededup.MIN_CHARS)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(table(spark, sf_dir, "documents"), id_remainder(F.col("doc_id"), 7) == 2)


def op8_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    learned = labels.where(id_remainder(F.col("doc_id"), 5) != 0)
    net = quality.fit(*quality.training_rows(docs, learned, QUALITY_TRAIN_ROWS))
    out = quality.scored(docs.withColumn("held_out", id_remainder(F.col("doc_id"), 5) == 0), net, ["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op9_lcp_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lcp.with_next(table(spark, sf_dir, "documents"))


def op10_url_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmers.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], window=13, m=3)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_arc_to_warc, op2_simhash_near_dedup, op3_language_id, op4_benchmark_decontamination, op5_mixing_weights,
        op6_line_dedup, op7_ppm_scoring, op8_quality_cnn, op9_lcp_fingerprints, op10_url_redirect_filter,
        op11_super_kmers, op12_spelling_variants, op13_prefix_trie, pipeline,
    )
}

_OP1 = f"""
with payloads as (select page_id, encode(coalesce(html, '')) p from pages),
pieces as (
  select page_id, octet_length(p) payload_bytes,
    list_transform(range(8), lambda i: ('0x' || substr(sha1(p), (1 + 5 * i)::int, 5))::bigint) twenty_bits from payloads),
named as (
  select page_id, payload_bytes::bigint payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + ((twenty_bits[1 + i // 4] >> (15 - 5 * (i % 4))::int) & 31))::int, 1)), '') payload_digest
  from pieces),
kept as (select payload_digest, max(page_id) last_id from named where payload_bytes >= {WARC_MIN_BYTES} group by 1)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= {WARC_MIN_BYTES} and page_id < last_id then 'revisit' else 'response' end record_type,
  case when payload_bytes >= {WARC_MIN_BYTES} and page_id < last_id then last_id end refers_to
from named left join kept using (payload_digest)
"""

_OP5 = """
with t as (
  select doc_id, coalesce(lang, '(none)') lang, coalesce(source, '(none)') source,
    case when source in ('src0') then 'crawl'
         when source in ('src1', 'src2', 'src3', 'src4', 'src5', 'src6') then 'news'
         when source in ('src7', 'src8', 'src9', 'src10', 'src11', 'src12', 'src13') then 'books' else 'other' end as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint n_tokens
  from documents),
leaf as (select domain, lang, source, sum(n_tokens)::bigint have, 4 * sum(n_tokens)::bigint room from t group by all),
d as (
  select domain, sum(room)::bigint room, case domain when 'crawl' then 4 when 'news' then 3 when 'books' then 2 else 1 end w,
    sum(sum(have)) over ()::bigint total from leaf group by domain),
d1 as (select *, total - coalesce(sum(room) over (order by room::double / w::double, domain rows between unbounded preceding and 1 preceding), 0) as left_over,
    sum(w) over (order by room::double / w::double, domain rows between current row and unbounded following) ws from d),
d2 as (select *, room * ws <= w * left_over as full_up from d1),
d3 as (select domain, case when full_up then room else ((total - sum(case when full_up then room else 0 end) over ()) * w // greatest(sum(case when full_up then 0 else w end) over (), 1)) end::bigint budget from d2),
l as (
  select domain, lang, sum(room)::bigint room, case lang when 'en' then 6 when 'de' then 2 when 'fr' then 2 else 1 end w, any_value(budget) total
  from leaf join d3 using (domain) group by domain, lang),
l1 as (select *, total - coalesce(sum(room) over (partition by domain order by room::double / w::double, lang rows between unbounded preceding and 1 preceding), 0) as left_over,
    sum(w) over (partition by domain order by room::double / w::double, lang rows between current row and unbounded following) ws from l),
l2 as (select *, room * ws <= w * left_over as full_up from l1),
l3 as (select domain, lang, case when full_up then room else ((total - sum(case when full_up then room else 0 end) over (partition by domain)) * w // greatest(sum(case when full_up then 0 else w end) over (partition by domain), 1)) end::bigint budget from l2),
s as (select domain, lang, source, have, room, 1 w, budget total from leaf join l3 using (domain, lang)),
s1 as (select *, total - coalesce(sum(room) over (partition by domain, lang order by room::double / w::double, source rows between unbounded preceding and 1 preceding), 0) as left_over,
    sum(w) over (partition by domain, lang order by room::double / w::double, source rows between current row and unbounded following) ws from s),
s2 as (select *, room * ws <= w * left_over as full_up from s1),
s3 as (select domain, lang, source, have, case when full_up then room else ((total - sum(case when full_up then room else 0 end) over (partition by domain, lang)) * w // greatest(sum(case when full_up then 0 else w end) over (partition by domain, lang), 1)) end::bigint budget from s2),
o as (
  select t.*, budget, budget // have as passes, budget % have as rest,
    ('0x' || substr(md5('17:' || (budget // have)::bigint || ':' || coalesce(doc_id::varchar, '')), 1, 15))::bigint place
  from t join s3 using (domain, lang, source) where have > 0),
c as (select *, sum(n_tokens) over (partition by domain, lang, source order by place, doc_id range between unbounded preceding and current row) upto from o)
select doc_id, domain, lang, source, n_tokens, budget, (passes + case when upto <= rest then 1 else 0 end)::int epochs
from c where passes + case when upto <= rest then 1 else 0 end > 0
"""

_KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP6 = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) pos from documents),
keyed as (select doc_id, pos, line, {_KEY} k from lines),
common as (select k from keyed where length(k) >= {linededup.MIN_CHARS} group by k having count(distinct doc_id) >= {linededup.MIN_DOCS}),
marked as (select keyed.*, common.k is not null as gone from keyed left join common using (k))
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id
"""

def _url_columns(url: str) -> str:
    """SQL: host, path and node (the form that aliases share, dot segments left as they are) of a url."""
    whole = f"instr(coalesce({url}, ''), '://') > 0"
    part = lambda pattern: f"regexp_extract({url}, '(?s)^.*?://{pattern}', 1)"
    host = f"translate({part('([^/?#]*)')}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rest = f"regexp_replace({part('[^/?#]*([^#]*)')}, '([?&])(?:(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*(?:&|$))+', '\\1', 'g')"
    rest = f"regexp_replace(regexp_replace({rest}, '[?&]$', ''), '/$', '')"
    return f"""case when {whole} then {host} else '' end host, case when {whole} then {part('[^/?#]*([^?#]*)')} else '' end path,
    case when {whole} then '//' || {host} || {rest} else {url} end node"""


_RULE = """case
    when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
    when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
    when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
    when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end"""
_OP10 = f"""
with recursive tags as (
  select url, unnest(regexp_extract_all(regexp_replace(html,
    '(?is)<!--.*?(?:-->|\\z)|<script\\b.*?(?:</script\\s*>|\\z)|<style\\b.*?(?:</style\\s*>|\\z)', ' ', 'g'), '(?is)<(?:link|meta)\\b[^>]*>')) tag
  from pages where regexp_matches(html, '(?i)canonical|refresh')),
links as (
  select url a, b from (select url, case
      when regexp_matches(tag, '(?is)^<link\\b.*?\\srel\\s*=\\s*["'']?canonical') then regexp_extract(tag, '(?is)\\shref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
      when regexp_matches(tag, '(?is)^<meta\\b.*?\\shttp-equiv\\s*=\\s*["'']?refresh') then regexp_extract(tag, '(?is)\\scontent\\s*=.*?url\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    end b from tags) where url is not null and instr(b, '://') > 0),
r as (select *, {_RULE} as rule from (select page_id, url, {_url_columns('url')} from pages)),
ends as (select *, {_RULE} as rule from (select {_url_columns('url')} from (select a url from links union select b from links))),
edges as (
  select x.node a, y.node b from (select a, b, {_url_columns('a')} from links) x join (select a, b, {_url_columns('b')} from links) y using (a, b) where x.node <> y.node),
both_ways as (select a, b from edges union select b, a from edges),
reach as (select distinct a node, a other from both_ways union select node, b from reach join both_ways on other = a),
said as (
  select node, bool_or(rule in ('example.net/en/', 'org/fr/')) allowed, bool_or(rule in ('net/', 'example.com/de/')) blocked
  from (select node, rule from r union all select node, rule from ends) group by node),
g as (
  select node, coalesce(bool_or(allowed), false) allowed, coalesce(bool_or(blocked), false) blocked
  from (select node, allowed, blocked from said union all select reach.node, allowed, blocked from reach join said on other = said.node) group by node)
select page_id, host, path, rule,
  case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule in ('net/', 'example.com/de/') then 'block'
       when blocked and not allowed then 'block' else 'allow' end verdict
from r left join g on r.node = g.node
"""

_OP11 = """
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') ws from documents),
words as (select doc_id, unnest(ws) w, generate_subscripts(ws, 1) pos from texts),
starts as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') win from (select doc_id, ws, unnest(range(1, len(ws) - 11)) i from texts)),
firsts as (select win, min(doc_id) first_doc from starts group by win),
gone as (select distinct doc_id, unnest(range(i, i + 13)) pos from starts join firsts using (win) where doc_id > first_doc),
kept as (
  select words.doc_id, count(gone.pos) n_removed, string_agg(w, ' ' order by pos) filter (gone.pos is null) kept
  from words left join gone using (doc_id, pos) group by words.doc_id)
select doc_id, len(ws)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256
from texts left join kept using (doc_id)
"""

def _crc32(text: str) -> str:
    """SQL: the unsigned CRC-32 of a text's UTF-8, byte by byte and bit by bit."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * i + 1)::int, 2))::bigint"
    step = "case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    of_bytes = f"list_prepend(4294967295::bigint, list_transform(range(octet_length(encode({text}))), lambda i: {byte}))"
    return f"xor(list_reduce({of_bytes}, lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, j: {step})), 4294967295)"


_OP12 = f"""
with recursive runs as (
  select said, run, count(*) times
  from (select coalesce(doc_id::varchar, '') said, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run from documents)
  group by all),
hashed as (select run, times, {_crc32("(said || ':' || run)")} h from runs where length(run) >= 5),
noisy as (select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run) + 2)::int) else run end word, times from hashed),
words as (select word, sum(times)::bigint n from noisy where length(word) >= 5 group by word having sum(times) >= 3),
holes as (select word, i, substr(word, 1, i::int) || substr(word, (i + 2)::int) rest from (select word, unnest(range(0, length(word))) i from words)),
shorter as (select distinct holes.word longer, words.word shorter from holes join words on words.word = rest),
pairs as (
  select a.word, b.word other from holes a join holes b using (i, rest) where a.word <> b.word
  union select longer, shorter from shorter union select shorter, longer from shorter),
ranked as (
  select pairs.word, other, o.n other_n, count(*) over (partition by pairs.word) n_near, row_number() over (partition by pairs.word order by o.n desc, other) place
  from pairs join words o on o.word = other),
formed as (
  select words.word, n, coalesce(n_near, 0) n_near, case when other_n >= 2 * n then other end form, case when other_n >= 2 * n then other_n end form_n
  from words left join (select * from ranked where place = 1) r using (word)),
chain as (select word, word last_word from formed union all select chain.word, form from chain join formed on formed.word = last_word where form is not null)
select formed.word, form, last_word root, n, n_near::bigint n_near, form_n
from formed join chain using (word) where last_word in (select word from formed where form is null)
"""

_OP13 = f"""
with turns as (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations),
own as (select conv_id, list({{'r': r, 't': t}} order by turn nulls first, r, md5(t)) l from turns group by conv_id),
hashed as (select conv_id, l, {_crc32("coalesce(conv_id::varchar, '')")} % 4 h from own),
built as (select c.conv_id, list_concat(coalesce(b.l, [])[1:c.h], c.l[c.h + 1:]) l from hashed c left join own b on b.conv_id = c.conv_id - c.conv_id % 20),
members as (
  select conv_id, d, md5(to_json(l[1:d])::varchar) node, case when d > 0 then md5(to_json(l[1:d - 1])::varchar) end up, d = len(l) ends,
    case when d > 0 then len(regexp_extract_all(l[d].t, '[^\\x20\\x09-\\x0D]+')) else 0 end words
  from (select conv_id, l, unnest(range(0, len(l) + 1)) d from built)),
nodes as (
  select d, node, any_value(up) up, min(conv_id) conv_id, count(*) n_convs, any_value(words) words,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) ends_sha256
  from members group by d, node),
kids as (select d - 1 d, up node, count(*) n_children from nodes where d > 0 group by 1, 2),
full_nodes as (select nodes.*, coalesce(n_children, 0) n_children from nodes left join kids using (d, node)),
below as (select distinct a.d, a.node, b.d d2, b.node node2 from members a join members b on a.conv_id is not distinct from b.conv_id and b.d >= a.d),
sums as (
  select below.d, below.node, count(*) filter (n_children = 0) n_leaves, sum((n_convs - 1) * words) saved_tokens
  from below join full_nodes v on v.d = d2 and v.node = node2 group by 1, 2)
select f.conv_id, f.d depth, p.conv_id parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens::bigint saved_tokens, f.ends_sha256
from full_nodes f join sums using (d, node) left join nodes p on p.d = f.d - 1 and p.node = f.up
"""

#: Where SQL can express an operator. op10's follows links that are written as absolute urls; relative ones, entities and dot segments
#: occur in none of the given tables and are held against the tests' own search.
ORACLES = {"op1_arc_to_warc": _OP1, "op5_mixing_weights": _OP5, "op6_line_dedup": _OP6, "op10_url_redirect_filter": _OP10, "op11_super_kmers": _OP11,
           "op12_spelling_variants": _OP12, "op13_prefix_trie": _OP13}
