"""Note cleaning, keywords, tokens and term weights. Notes = documents and pages, class = labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.catalog.registry import Tables, query
from lossloom.functions import text as X
from lossloom.operators import joins as J
from lossloom.operators import terms as V
from lossloom.session import materialise

# Stop words of the term queries, the same list in the SQL.
STOPS = ("that", "with", "this", "from", "which", "there")
_STOP_SQL = ", ".join(f"'{w}'" for w in STOPS)
_TOKENS = f"""
tokens as (select doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'),
             lambda w: length(w) >= 4 and w not in ({_STOP_SQL})) as toks from documents),
words as (select doc_id, generate_subscripts(toks, 1) as i, unnest(toks) as w from tokens)"""
_NGRAMS = _TOKENS + """,
next_words as (select doc_id, w, lead(w, 1) over (partition by doc_id order by i) as w2,
                      lead(w, 2) over (partition by doc_id order by i) as w3 from words),
grams as (select doc_id, w || ' ' || w2 as term from next_words where w2 is not null
          union all select doc_id, w || ' ' || w2 || ' ' || w3 from next_words where w3 is not null)"""


def documents_with_tokens(t: Tables):
    return t.documents.select("doc_id", X.tokens(F.col("text"), STOPS).alias("toks"))


def pieces_with_tokens(t: Tables):
    """Dealt before texts are cut, since a text is smaller than its tokens."""
    return V.in_pieces(t.documents.select("doc_id", "text"), "doc_id").select("piece", X.tokens(F.col("text"), STOPS).alias("toks"))


@query("""
select doc_id,
  case when contains(upper(text), 'THE') or contains(upper(text), 'ING') then 1 else 0 end as fire,
  case when regexp_matches(lower(text), 'loss') then 1 else 0 end as totalloss_flag,
  case when regexp_matches(lower(text), 'tion | ther') then 1 else 0 end as glass_flag,
  case when regexp_matches(lower(text), 'heed') and regexp_matches(lower(text), 'then|erst') then 1 else 0 end as both_flag,
  case when contains(lower(text), 'ent wh') then 1 else 0 end as kp_0,
  case when contains(lower(text), 'ing th') then 1 else 0 end as kp_1
from documents""")
def keyword_flags(t: Tables):
    text = F.col("text")
    rules = [
        X.KeywordRule("totalloss_flag", any_of=("loss",)), X.KeywordRule("glass_flag", any_of=("tion ", " ther")),
        X.KeywordRule("both_flag", all_of=("heed",), any_of=("then", "erst")),
    ]
    return t.documents.select(
        "doc_id", X.contains_any(F.upper(text), ["THE", "ING"]).alias("fire"), *X.keyword_flags(text, rules),
        *X.phrase_flags(text, ["ENT WH", "ING TH"], prefix="kp_"))


@query("""
select doc_id, cast((length(text) - length(replace(text, 'the', ''))) / 3 as bigint) as n_the,
  cast((length(text) - length(replace(text, 'ing', ''))) / 3 as bigint) as n_ing,
  cast((length(text) - length(replace(text, 'nn', ''))) / 2 as bigint) as n_nn from documents""")
def phrase_counts(t: Tables):
    text = F.col("text")
    return t.documents.select("doc_id", *[X.phrase_count(text, p).alias(f"n_{p}") for p in ("the", "ing", "nn")])


@query(r"""
with a as (select page_id, regexp_replace(html, '<.*?>', '', 'g') as s from pages),
b as (select page_id, replace(replace(replace(replace(s, '&lt;', 'less'), '&gt;', 'greater'), '&amp;', 'and'), 'x0D', '') as s from a),
c as (select page_id, replace(translate(s, chr(10) || chr(13) || '*', '   '), '&#;', '') as s from b),
d as (select page_id, replace(replace(translate(s, chr(9) || '()', ''), 'null,', ''), chr(39), '') as s from c),
e as (select page_id, regexp_replace(regexp_replace(s, '[^A-Za-z,.\[space]\]+', '', 'g'), '[ \t]+', ' ', 'g') as lit,
             regexp_replace(regexp_replace(s, '[^A-Za-z0-9,. ]+', '', 'g'), '[ \t]+', ' ', 'g') as strict from d)
select page_id, md5(lit) as literal_hash, cast(length(lit) as integer) as literal_n, strict as strict_text,
  regexp_replace(lit, '[^ \t\n\r\x0B\x0Ca-zA-Z0-9]', '', 'g') as letters,
  md5(regexp_replace(lit, '^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$', '', 'g')) as stripped_hash from e""")
def clean_note(t: Tables):
    """Both character filters, the alphanumeric filter and the punctuation strip over whole pages."""
    literal = X.clean_note(F.col("html"))
    pages = t.pages.select("page_id", literal.alias("lit"), X.clean_note(F.col("html"), keep_digits=True, strict=True).alias("strict_text"))
    return pages.select(
        "page_id", F.md5("lit").alias("literal_hash"), F.length("lit").alias("literal_n"), "strict_text",
        X.letters_digits_blanks(F.col("lit")).alias("letters"), F.md5(X.strip_punctuation(F.col("lit"))).alias("stripped_hash"))


@query(f"""
with {_TOKENS}
select d.doc_id, cast(len(string_split(d.text, ' ')) as integer) as n_blank,
  cast(len(list_filter(string_split_regex(d.text, '[ \\t\\n\\r\\f\\v]+'), lambda w: w <> '')) as integer) as n_words,
  cast(len(t.toks) as integer) as n_tokens, array_to_string(t.toks, ' ') as clean_text,
  cast(len(list_filter(string_split_regex(lower(regexp_replace(d.text, '[^ \\t\\n\\r\\f\\va-zA-Z0-9]', '', 'g')), '[ \\t\\n\\r\\f\\v]+'),
       lambda w: w <> '' and w not in ({_STOP_SQL}))) as integer) as n_topic_words
from documents d join tokens t on d.doc_id = t.doc_id""")
def token_split(t: Tables):
    d = t.documents.select(
        "doc_id", F.size(X.blank_split(F.col("text"))).alias("n_blank"),
        F.size(X.blank_split(F.col("text"), keep_empty=False)).alias("n_words"),
        X.tokens(F.col("text"), STOPS).alias("toks"), F.size(X.topic_words(F.col("text"), STOPS)).alias("n_topic_words"))
    return d.select("doc_id", "n_blank", "n_words", F.size("toks").alias("n_tokens"),
                    F.array_join("toks", " ").alias("clean_text"), "n_topic_words")


@query(f"""
with {_NGRAMS}
select term, count(*) as n, count(distinct doc_id) as docs from grams group by 1""")
def ngrams(t: Tables):
    """Bigrams and trigrams with occurrences and documents."""
    grams = pieces_with_tokens(t).select("piece", X.ngram_range(F.col("toks"), 2, 3).alias("terms"))
    return V.vocabulary(grams, "terms", by="piece").select("term", F.col("tf").alias("n"), F.col("df").alias("docs"))


@query(f"""
with {_TOKENS}, stems(token, stem) as (select distinct w, substr(w, 1, 5) from words where length(w) > 7)
select doc_id, coalesce(stem, w) as stem, count(*) as n from words left join stems on w = token group by 1, 2""")
def stem_table(t: Tables):
    """Tokens replaced through a token-to-stem table that is itself data."""
    # Read twice: texts are cut once.
    docs = materialise(documents_with_tokens(t))
    seen = docs.select(F.explode("toks").alias("token")).filter(F.length("token") > 7).distinct()
    return V.stem_by_table(docs, "doc_id", "toks", seen.select("token", F.substring("token", 1, 5).alias("stem")))


@query(f"""with {_TOKENS} select w as term, count(distinct doc_id) as df, count(*) as tf from words group by 1""")
def term_counts(t: Tables):
    return V.vocabulary(pieces_with_tokens(t), "toks", by="piece")


@query(f"""
with {_NGRAMS},
vocab as (select term, count(distinct doc_id) as df, count(*) as tf from grams group by 1 order by tf desc, term limit 500),
counts as (select g.doc_id, g.term, count(*) * (ln((select count(*) from documents)::double / max(v.df)) + 1) as raw
           from grams g join vocab v on g.term = v.term group by 1, 2)
select doc_id, term, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 4) as weight from counts""")
def tfidf(t: Tables):
    """Top 500 bigrams and trigrams, idf = ln(N / df) + 1, unit length per document."""
    # Read three times: texts are cut once.
    docs = materialise(documents_with_tokens(t))
    grams = docs.select("doc_id", X.ngram_range(F.col("toks"), 2, 3).alias("terms"))
    model, positions = V.tfidf_model(grams, "terms", 500)
    entries = V.vector_entries(V.tfidf_vectors(grams, model), ["doc_id"], "tfidf")
    return entries.join(F.broadcast(positions), "pos").select("doc_id", "term", F.round("weight", 4).alias("weight"))


@query(f"""
with {_TOKENS}, counts as (select doc_id, w as term, count(*) as tf from words group by 1, 2),
dfs as (select term, count(*) as df from counts group by 1),
raw as (select doc_id, c.term, tf * log2((select count(*) from documents)::double / df) as raw from counts c join dfs d on c.term = d.term)
select doc_id, term, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 4) as weight from raw where raw <> 0""")
def tfidf_log2(t: Tables):
    """All tokens, idf = log2(N / df), zero weights left out, unit length per document."""
    table = V.tfidf_table(documents_with_tokens(t), "doc_id", "toks", V.log2_idf)
    return table.select("doc_id", "term", F.round("weight", 4).alias("weight"))


@query(f"""
with {_NGRAMS.replace('from documents)', 'from documents where doc_id in (select doc_id from labels))')},
vocab as (select term, count(distinct doc_id) as df, count(*) as tf from grams group by 1 order by tf desc, term limit 300),
n as (select count(*)::double as n from documents where doc_id in (select doc_id from labels)),
raw as (select g.doc_id, g.term, max(v.df) as df, count(*) * (ln((select n from n) / max(v.df)) + 1) as raw
        from grams g join vocab v on g.term = v.term group by 1, 2),
w as (select r.doc_id, r.term, df, raw / sqrt(sum(raw * raw) over (partition by r.doc_id)) as weight, l.quality
      from raw r join labels l on r.doc_id = l.doc_id),
shares as (select quality, count(*) / (select n from n) as share from labels where doc_id in (select doc_id from documents) group by 1),
tot as (select term, max(df) as df, sum(weight) as total from w group by 1),
obs as (select t.term, s.quality, s.share * t.total as e, coalesce(sum(w.weight), 0) as o
        from tot t cross join shares s left join w on w.term = t.term and w.quality = s.quality group by t.term, s.quality, s.share, t.total)
select t.term, round(sum((o - e) * (o - e) / e), 4) as chi2, round(ln((select n from n) / max(t.df)) + 1, 4) as idf,
  round(sum((o - e) * (o - e) / e) * (ln((select n from n) / max(t.df)) + 1), 4) as weight
from tot t join obs on t.term = obs.term group by t.term""")
def chi2_terms(t: Tables):
    """Key-phrase importance over labelled documents: chi-square times idf."""
    docs = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id").select(
        "doc_id", "quality", X.tokens(F.col("text"), STOPS).alias("toks"))
    grams = docs.select("doc_id", "quality", X.ngram_range(F.col("toks"), 2, 3).alias("terms"))
    phrases = V.key_phrases(grams, "doc_id", "terms", "quality", 300)
    return phrases.select("term", *[F.round(c, 4).alias(c) for c in ("chi2", "idf", "weight")])


@query(f"""
with {_TOKENS.replace('from documents)', 'from documents where doc_id in (select doc_id from labels))')},
n as (select count(*)::double as n from documents where doc_id in (select doc_id from labels)),
counts as (select doc_id, w as term, count(*) as tf from words group by 1, 2),
dfs as (select term, count(*) as df from counts group by 1),
raw as (select c.doc_id, c.term, d.df, tf * (ln((select n from n) / d.df) + 1) as raw from counts c join dfs d on c.term = d.term),
w as (select r.doc_id, r.term, df, raw / sqrt(sum(raw * raw) over (partition by r.doc_id)) as weight, l.toxic
      from raw r join labels l on r.doc_id = l.doc_id),
shares as (select toxic, count(*) / (select n from n) as share from labels where doc_id in (select doc_id from documents) group by 1),
tot as (select term, max(df) as df, sum(weight) as total from w group by 1),
obs as (select t.term, s.toxic, s.share * t.total as e, coalesce(sum(w.weight), 0) as o
        from tot t cross join shares s left join w on w.term = t.term and w.toxic = s.toxic group by t.term, s.toxic, s.share, t.total)
select t.term, round(sum((o - e) * (o - e) / e), 4) as chi2, round(ln((select n from n) / max(t.df)) + 1, 4) as idf
from tot t join obs on t.term = obs.term group by t.term""")
def chi2_all_terms(t: Tables):
    """The same scores without a vocabulary limit, all in (document, term) form."""
    docs = t.documents.join(t.labels.select("doc_id", "toxic"), "doc_id").select(
        "doc_id", "toxic", X.tokens(F.col("text"), STOPS).alias("toks"))
    phrases = V.key_phrases(docs, "doc_id", "toks", "toxic", None)
    return phrases.select("term", F.round("chi2", 4).alias("chi2"), F.round("idf", 4).alias("idf"))
