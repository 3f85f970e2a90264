"""Text cleaning, vocabularies and TF-IDF over whole documents."""

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import vocabulary as voc
from tessera.plans.registry import query, rounded
from tessera.session import load, load_spread, written

CLEAN = f"""regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(lower(text), 'https?://[^{text.SPACE}]+', '', 'g'),
  chr(10), ' '), '[^a-z{text.SPACE}]', '', 'g'), ' +', ' ', 'g'), '^[{text.SPACE}]+|[{text.SPACE}]+$', '', 'g')"""
STOPS = ", ".join("'" + w.replace("'", "''") + "'" for w in text.ENGLISH_STOP_WORDS)
MAIL = rf"""list_filter(regexp_split_to_array(regexp_replace(lower(text), '[!-/:-@\[-`{{-~]', ' ', 'g'), '\s+'),
  lambda w: regexp_full_match(w, '\p{{L}}{{2,}}') and not list_contains([{STOPS}], w))"""
WORDS = f"w as (select doc_id, list_filter(regexp_split_to_array({CLEAN}, '[{text.SPACE}]+'), lambda w: w <> '') as tokens from documents)"
TOKENS = """t as (select doc_id, unnest(tokens) as token, unnest(range(len(tokens))) as pos from w)"""
RANKED = """c as (select token, count(*) as n, min((doc_id, pos)) as first from t group by 1),
v as (select token, n, row_number() over (order by n desc, first) as rank from c)"""
MAILS = f"""m as (select doc_id, {MAIL} as tokens from documents), u as (select doc_id, unnest(tokens) as token from m),
f as (select token, count(distinct doc_id) as documents, count(distinct doc_id) / (select count(*) from m) as share from u group by 1)"""


def comment_tokens(spark, d):
    return load_spread(spark, d, "documents", "doc_id").select(
        "doc_id", text.comment_words(F.col("text")).alias("tokens"))


def mails(spark, d):
    return load_spread(spark, d, "documents", "doc_id").select("doc_id", text.mail_tokens(F.col("text")).alias("tokens"))


@query("cleaned_comments", f"select doc_id, {CLEAN} as comment from documents")
def cleaned_comments(spark, d):
    return load_spread(spark, d, "documents", "doc_id").select("doc_id", text.cleaned_comment(F.col("text")).alias("comment"))


@query("cleaned_mails", f"select doc_id, array_to_string({MAIL}, ' ') as mail from documents")
def cleaned_mails(spark, d):
    return load_spread(spark, d, "documents", "doc_id").select("doc_id", text.cleaned_mail(F.col("text")).alias("mail"))


@query("token_counts", f"with {WORDS}, {TOKENS} select token, count(*) as n from t group by 1")
def token_counts(spark, d):
    return voc.token_counts(comment_tokens(spark, d), "doc_id", "tokens").select("token", "n")


@query("ranked_vocabulary", f"with {WORDS}, {TOKENS}, {RANKED} select * from v")
def ranked_vocabulary(spark, d):
    return voc.vocabulary(comment_tokens(spark, d), "doc_id", "tokens")


@query("token_length_distribution", f"""with {WORDS}, l as (select doc_id, len(tokens) as n from w)
select cast(max(n) as integer) as longest, (select doc_id from l order by n desc, doc_id limit 1) as longest_id,
  round(quantile_cont(cast(n as double), 0.90), 6) as p90, round(quantile_cont(cast(n as double), 0.95), 6) as p95,
  round(quantile_cont(cast(n as double), 0.99), 6) as p99 from l""")
def token_length_distribution(spark, d):
    return rounded(voc.length_distribution(comment_tokens(spark, d), "doc_id", "tokens"))


COVERED = """k as (select token, n, row_number() over (order by n desc, token) as rank,
  cast(sum(n) over (order by n desc, token rows unbounded preceding) as bigint) as covered from c)"""


@query("vocabulary_coverage", f"""with {WORDS}, {TOKENS}, {RANKED}, {COVERED}
select *, round(covered / (select max(covered) from k), 6) as covered_share from k""")
def vocabulary_coverage(spark, d):
    counts = voc.token_counts(comment_tokens(spark, d), "doc_id", "tokens")
    return rounded(voc.coverage(counts))


LEMMAS = f"""m as (select doc_id, {MAIL.replace(STOPS, "''")} as tokens from documents),
u as (select doc_id, unnest(tokens) as token, unnest(range(len(tokens))) as pos from m),
w as (select distinct token from u),
l as (select token as word, left(token, length(token) - 1) as lemma from w
  where token like '%s' and length(token) > 3 and left(token, length(token) - 1) in (select token from w)),
k as (select doc_id, pos, coalesce(lemma, token) as token from u left join l on word = token)"""


@query("lemmatised_mails", f"""with {LEMMAS},
g as (select doc_id, string_agg(token, ' ' order by pos) as mail from k where token not in ({STOPS}) group by 1)
select doc_id, coalesce(mail, '') as mail from m left join g using (doc_id)""")
def lemmatised_mails(spark, d):
    """Lemmas before the stop list, as the mails are cleaned; the dictionary is derived from the corpus."""
    tokens = load_spread(spark, d, "documents", "doc_id").select("doc_id", text.mail_tokens(F.col("text"), [""]).alias("tokens"))
    tokens = written(tokens, "tokens")
    words = voc.unfolded(tokens, [], "tokens", "token").distinct()
    dictionary = voc.small(written(voc.plural_lemmas(words), "lemmas"))  # else all tokens would be shuffled to meet it
    lemmas = voc.lemmatised(tokens, "doc_id", "tokens", dictionary)
    kept = F.filter("tokens", lambda w: ~w.isin(*text.ENGLISH_STOP_WORDS))
    return lemmas.select("doc_id", F.array_join(kept, " ").alias("mail"))


@query("vocabulary_cutoff", f"""with {WORDS}, {TOKENS}, {RANKED}, {COVERED},
s as (select rank, covered / (select max(covered) from k) as share from k)
select x as share, min(rank) filter (where s.share >= x) as words from s, (values (0.99::double), (0.97::double)) as q(x) group by 1""")
def vocabulary_cutoff(spark, d):
    counts = voc.token_counts(comment_tokens(spark, d), "doc_id", "tokens")
    return voc.coverage_cutoff(voc.coverage(counts), [0.99, 0.97])


NUM_WORDS, LENGTH = 30_000, 200


@query("padded_sequences", f"""with {WORDS}, {TOKENS}, {RANKED},
e as (select doc_id, list(coalesce(case when rank + 1 < {NUM_WORDS} then cast(rank + 1 as integer) end, 1) order by pos) as ids
  from t left join v using (token) group by 1)
select doc_id, list_concat(coalesce(ids, []), list_transform(range({LENGTH}), lambda x: 0))[1:{LENGTH}] as ids
from w left join e using (doc_id)""")
def padded_sequences(spark, d):
    tokens = written(comment_tokens(spark, d), "tokens")  # cleaned once
    ranked = voc.vocabulary(tokens, "doc_id", "tokens")
    ahead = tokens.withColumn("tokens", F.slice("tokens", 1, LENGTH))  # what padding would cut off is not looked up
    encoded = voc.encode(ahead, "doc_id", "tokens", ranked, NUM_WORDS)
    return encoded.withColumn("ids", voc.padded(F.col("ids"), LENGTH))


@query("tfidf_weights", f"""with {MAILS},
k as (select token, ln((1 + (select count(*) from m)) / (1 + documents)) + 1 as idf from f where documents >= 3 and share <= 0.3),
x as (select doc_id, token, count(*) as n, count(*) * any_value(idf) as raw from u join k using (token) group by 1, 2)
select doc_id, token, n, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 6) as weight from x""")
def tfidf_weights(spark, d):
    return rounded(voc.tfidf(mails(spark, d), "doc_id", "tokens"))


@query("document_frequency_top", f"with {MAILS} select token, documents, round(share, 6) as share from f order by documents desc, token limit 25")
def document_frequency_top(spark, d):
    frequency = voc.document_frequency(mails(spark, d), "tokens")
    return rounded(frequency.orderBy(F.desc("documents"), "token").limit(25))


@query("filtered_dictionary", f"with {MAILS} select token, documents, round(share, 6) as share from f where documents >= 3 and share <= 0.25 order by documents desc, token limit 100000")
def filtered_dictionary(spark, d):
    return rounded(voc.filter_extremes(voc.document_frequency(mails(spark, d), "tokens"), 3, 0.25, 100_000))


@query("bag_of_words", f"""with {MAILS},
k as (select token, row_number() over (order by token) - 1 as token_id from f where documents >= 3 and share <= 0.25)
select doc_id, token_id, count(*) as n from u join k using (token) group by 1, 2""")
def bag_of_words(spark, d):
    tokens = written(mails(spark, d), "tokens")
    kept = voc.filter_extremes(voc.document_frequency(tokens, "tokens"), 3, 0.25, 100_000)
    return voc.bag_of_words(tokens, "doc_id", "tokens", kept)


MENTIONS = "(select doc_id, unnest(regexp_extract_all(text, '[A-Z][A-Za-z&]+(?: [A-Z][A-Za-z&]+)+')) as mention from documents)"


@query("name_mentions", f"select doc_id, mention, count(*) as n from {MENTIONS} group by 1, 2")
def name_mentions(spark, d):
    found = voc.mentions(load_spread(spark, d, "documents", "doc_id"), "doc_id", "text")
    return found.groupBy("doc_id", "mention").agg(F.count(F.lit(1)).alias("n"))


@query("top_name_mentions", f"select mention, count(*) as n from {MENTIONS} group by 1 order by n desc, mention limit 20")
def top_name_mentions(spark, d):
    found = voc.mentions(load_spread(spark, d, "documents", "doc_id"), "doc_id", "text")
    return voc.mention_counts(found).orderBy(F.desc("n"), "mention").limit(20)
