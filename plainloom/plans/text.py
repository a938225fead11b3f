"""Text cleaning, tokens, vocabularies, weights, sequences and sentiment."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from plainloom.functions import arrays as A
from plainloom.functions import text as X
from plainloom.operators import relational, textstats
from plainloom.plans.catalog import query
from plainloom.session import spread, stage, table

# parameters of the queries: stop words and a scored lexicon
STOP_WORDS = ["the", "and", "of", "is", "it", "on", "in", "to", "at", "as", "by", "an", "with", "that", "for"]
LEXICON = {
    "the": 1.0, "that": 1.5, "with": 0.5, "on": 2.0, "que": 1.0, "des": 0.5,
    "and": -1.0, "of": -0.5, "it": -2.0, "les": -1.0, "une": -1.5,
}
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
LEXICON_SQL = "(VALUES " + ", ".join(f"('{w}', {s}::DOUBLE)" for w, s in LEXICON.items()) + ") AS lex(term, score)"
WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
TERMS_SQL = f"""tokens AS (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2),
    df AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY 1),
    n AS (SELECT count(*) AS n FROM documents)"""


def rep(expression, pattern, by=""):
    return f"regexp_replace({expression}, '{pattern}', '{by}', 'g')"


def words():
    # a function: a Column needs a running session, this module does not
    return X.word_tokens(F.col("text"))


def texts(spark, sf, name, *columns):
    return spread(table(spark, sf, name).select(*columns))


@query(
    "clean_text",
    "SELECT doc_id, trim("
    + rep(rep("trim(lower(text))", r"[^a-zA-Z\s]"), " +", " ")
    + ") AS headline, "
    + rep(rep(rep("lower(text)", r"[^\p{L}\p{N}_\s]"), r"\p{Nd}+"), r"[\r\n]")
    + " AS review FROM documents",
)
def clean_text(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", X.clean_headline(F.col("text")).alias("headline"), X.clean_review(F.col("text")).alias("review")
    )


POST_SQL = "lower({c})"
for _p in (r"\[[^\n]*?\]", r"https?://\S+|www\.\S+", r"<[^\n]*?>+", r"[!-/:-@\[-`{{-~]", r"\n", r"[\p{{L}}\p{{N}}_]*\p{{Nd}}[\p{{L}}\p{{N}}_]*"):
    POST_SQL = rep(POST_SQL, _p)


@query(
    "strip_urls_tags",
    f"""SELECT page_id AS id, 'page' AS kind, {POST_SQL.format(c='html')} AS cleaned FROM pages
        UNION ALL SELECT doc_id, 'document', {POST_SQL.format(c='text')} FROM documents""",
)
def strip_urls_tags(spark, sf):
    pages = texts(spark, sf, "pages", F.col("page_id").alias("id"), F.lit("page").alias("kind"), F.col("html").alias("t"))
    docs = texts(spark, sf, "documents", "doc_id", F.lit("document"), "text")
    return pages.union(docs).select("id", "kind", X.clean_post(F.col("t")).alias("cleaned"))


_social = rep("lower(" + rep("text", r"[\n\t]", " ") + ")", r"@\S+")
_social = rep(rep(_social, r"(^|[^\p{L}\p{N}_])#\S+", r"\1"), r"http\S+")
_social = "trim(" + rep(_social, r"[^\p{L}\p{N}_]+", " ") + ")"


@query(
    "strip_mentions",
    "SELECT doc_id, " + rep(rep(_social, r"\s+[b-zA-Z]\s+", " "), r"\s+", " ") + " AS cleaned FROM documents",
)
def strip_mentions(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", X.clean_social(F.col("text")).alias("cleaned"))


@query(
    "tokenise",
    rf"""SELECT doc_id, array_to_string([t FOR t IN regexp_split_to_array(lower(text), '\s+') IF t <> ''], ' ') AS pieces,
              array_to_string({WORDS_SQL}, ' ') AS words,
              CAST(len([t FOR t IN regexp_split_to_array(lower(text), '\s+') IF t <> '']) AS INTEGER) AS n_pieces,
              CAST(len({WORDS_SQL}) AS INTEGER) AS n_words FROM documents""",
)
def tokenise(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", X.space_tokens(F.lower("text")).alias("p"), words().alias("w")
    )
    return docs.select(
        "doc_id",
        F.array_join("p", " ").alias("pieces"),
        F.array_join("w", " ").alias("words"),
        F.size("p").alias("n_pieces"),
        F.size("w").alias("n_words"),
    )


@query(
    "text_length",
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents WHERE length(text) <= 2000 AND NOT lang = 'en'",
)
def text_length(spark, sf):
    docs = table(spark, sf, "documents").where((F.length("text") <= 2000) & ~(F.col("lang") == "en"))
    return docs.select("doc_id", F.length("text").alias("n"))


@query(
    "max_tokens",
    f"SELECT lang, CAST(max(len({WORDS_SQL})) AS INTEGER) AS longest FROM documents GROUP BY lang",
)
def max_tokens(spark, sf):
    return texts(spark, sf, "documents", "lang", "text").groupBy("lang").agg(F.max(F.size(words())).alias("longest"))


@query(
    "comma_parts_clean",
    """SELECT p_partkey, lower(replace(p_name, ' ', '')) || ' ' || lower(p_type) || ' '
              || regexp_replace(lower(p_brand), '[^a-z]', '', 'g') AS bag FROM part""",
)
def comma_parts_clean(spark, sf):
    text = F.concat("p_name", F.lit(" (size 7), "), "p_type", F.lit("42, "), "p_brand", F.lit("!"))
    return table(spark, sf, "part").select("p_partkey", X.clean_comma_parts(text).alias("bag"))


@query(
    "explode_parts",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1",
)
def explode_parts(spark, sf):
    return textstats.token_counts(table(spark, sf, "part"), F.split("p_name", " "), name="word")


@query(
    "characters",
    "SELECT c, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?s).')) AS c FROM conversations) GROUP BY 1",
)
def characters(spark, sf):
    return textstats.token_counts(texts(spark, sf, "conversations", "text"), X.characters(F.col("text")), name="c")


@query(
    "char_ngrams",
    """SELECT p_partkey, array_to_string([substr(p_name, i, 3) FOR i IN range(1, length(p_name) + 1)], '|') AS grams
       FROM part""",
)
def char_ngrams(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(X.char_ngrams(F.col("p_name"), 3), "|").alias("grams")
    )


@query("token_counts", f"WITH {TERMS_SQL} SELECT term, total AS n FROM df ORDER BY n DESC, term")
def token_counts(spark, sf):
    counts = textstats.token_counts(texts(spark, sf, "documents", "text"), words())
    return counts.orderBy(F.col("n").desc(), "term")


@query(
    "class_word_counts",
    f"""WITH c AS (SELECT quality, term, count(*) AS n FROM
          (SELECT quality, unnest({WORDS_SQL}) AS term FROM documents JOIN labels USING (doc_id)) GROUP BY 1, 2)
        SELECT quality, term, n FROM c
        QUALIFY row_number() OVER (PARTITION BY quality ORDER BY n DESC, term) <= 200""",
)
def class_word_counts(spark, sf):
    # the 200 words a word cloud shows, per class
    labelled = texts(spark, sf, "documents", "doc_id", "text").join(table(spark, sf, "labels"), "doc_id")
    counts = textstats.token_counts(labelled, words(), ["quality"])
    return textstats.top_per_group(counts, ["quality"], [F.col("n").desc(), "term"], 200)


@query(
    "ngrams",
    f"""WITH d AS (SELECT {WORDS_SQL} AS w FROM documents),
        g AS (SELECT unnest(w) AS gram FROM d UNION ALL
              SELECT unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM d)
        SELECT gram, count(*) AS n FROM g GROUP BY 1""",
)
def ngrams(spark, sf):
    grams = X.word_ngrams(words(), 1, 2)
    return textstats.token_counts(texts(spark, sf, "documents", "text"), grams, name="gram")


@query(
    "stopword_filter",
    f"""SELECT doc_id, array_to_string([w FOR w IN {WORDS_SQL} IF w NOT IN {STOP_SQL}], ' ') AS terms
        FROM documents""",
)
def stopword_filter(spark, sf):
    tokens = texts(spark, sf, "documents", "doc_id", "text").select("doc_id", words().alias("tokens"))
    remover = StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=STOP_WORDS)
    return remover.transform(tokens).select("doc_id", F.array_join("kept", " ").alias("terms"))


@query(
    "normalise_vocabulary",
    f"""SELECT doc_id, array_to_string([CASE WHEN length(w) > 5 THEN regexp_replace(w, '(ing|ed|es|s)$', '')
              ELSE w END FOR w IN {WORDS_SQL}], ' ') AS terms FROM documents""",
)
def normalise_vocabulary(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    mapping = textstats.vocabulary_map(docs, words(), X.strip_suffix)
    normal = textstats.normalise_tokens(docs, ["doc_id"], words(), mapping)
    return normal.select("doc_id", F.array_join("tokens", " ").alias("terms"))


@query(
    "normalise_in_place",
    f"""SELECT doc_id, array_to_string([CASE WHEN length(w) > 5 THEN regexp_replace(w, '(ing|ed|es|s)$', '')
              ELSE w END FOR w IN {WORDS_SQL}], ' ') AS terms FROM documents""",
)
def normalise_in_place(spark, sf):
    # the same rule without any shuffle: the choice when the rule is a cheap expression
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", F.array_join(F.transform(words(), X.strip_suffix), " ").alias("terms"))


@query(
    "term_frequency",
    f"""WITH {TERMS_SQL}, v AS (SELECT term FROM df WHERE df >= 10 ORDER BY total DESC, term LIMIT 1000)
        SELECT doc_id, term, tf FROM tf JOIN v USING (term)""",
)
def term_frequency(spark, sf):
    tf = textstats.term_frequencies(texts(spark, sf, "documents", "doc_id", "text"), "doc_id", words())
    return tf.join(textstats.vocabulary(tf, 1000, 10).select("term"), "term").select("doc_id", "term", "tf")


@query(
    "tfidf_plain",
    f"""WITH {TERMS_SQL} SELECT doc_id, term, round(tf * ln((n + 1) / (df + 1)), 6) AS weight
        FROM tf JOIN df USING (term), n""",
)
def tfidf_plain(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    tf = textstats.term_frequencies(docs, "doc_id", words())
    n = table(spark, sf, "documents").agg(F.count(F.lit(1))).scalar()
    out = textstats.tfidf_plain(tf, textstats.document_frequencies(tf), n)
    return out.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(
    "tfidf_smooth_l2",
    f"""WITH {TERMS_SQL}, w AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w
          FROM tf JOIN df USING (term), n WHERE df >= 5)
        SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def tfidf_smooth_l2(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    tf = textstats.term_frequencies(docs, "doc_id", words())
    n = table(spark, sf, "documents").agg(F.count(F.lit(1))).scalar()
    out = textstats.tfidf_smooth(tf, textstats.vocabulary(tf, min_df=5), n, "doc_id")
    return out.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(
    "nonempty_vectors",
    f"""WITH {TERMS_SQL}, v AS (SELECT term FROM df WHERE df >= 2 ORDER BY total DESC, term LIMIT 40)
        SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM tf JOIN v USING (term))""",
)
def nonempty_vectors(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text")
    tf = textstats.term_frequencies(docs, "doc_id", words())
    hits = tf.join(textstats.vocabulary(tf, 40, 2).select("term"), "term").select("doc_id").distinct()
    return table(spark, sf, "documents").select("doc_id", "lang").join(hits, "doc_id", "left_semi")


CONV_WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
INDEX_SQL = f"""idx AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) AS token_id FROM
    (SELECT unnest({CONV_WORDS_SQL}) AS term FROM conversations) GROUP BY term)"""


def conversation_index(spark, sf):
    return textstats.vocabulary_index(textstats.token_counts(texts(spark, sf, "conversations", "text"), words()))


@query("vocab_index", f"WITH {INDEX_SQL} SELECT term, token_id FROM idx")
def vocab_index(spark, sf):
    return conversation_index(spark, sf).select("term", "token_id")


ENCODED_SQL = f"""{INDEX_SQL},
    t AS (SELECT conv_id, turn, unnest({CONV_WORDS_SQL}) AS term,
                 generate_subscripts({CONV_WORDS_SQL}, 1) AS pos FROM conversations),
    e AS (SELECT conv_id, turn, list(token_id ORDER BY pos) AS ids FROM t JOIN idx USING (term) GROUP BY 1, 2)"""


@query(
    "encode_pad",
    f"""WITH {ENCODED_SQL}, m AS (SELECT max(len(ids)) AS m FROM e),
        r AS (SELECT conv_id, turn, coalesce(ids, []::BIGINT[]) AS ids FROM conversations LEFT JOIN e USING (conv_id, turn))
        SELECT conv_id, turn, trim(repeat('0 ', m - len(ids)) || array_to_string(ids, ' ')) AS front,
               trim(array_to_string(ids, ' ') || repeat(' 0', m - len(ids))) AS back FROM r, m""",
)
def encode_pad(spark, sf):
    conversations, index = texts(spark, sf, "conversations", "conv_id", "turn", "text"), conversation_index(spark, sf)
    # staged: read for the longest row and for the result
    encoded = stage(textstats.encode_tokens(conversations, ["conv_id", "turn"], words(), index))
    longest = encoded.agg(F.max(F.size("ids"))).scalar()
    return encoded.select(
        "conv_id",
        "turn",
        F.array_join(A.pad_left(F.col("ids"), longest), " ").alias("front"),
        F.array_join(A.pad_right(F.col("ids"), longest), " ").alias("back"),
    )


LINES_SQL = f"""l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS text,
      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM conversations),
    t AS (SELECT conv_id, turn, line, unnest({CONV_WORDS_SQL}) AS term,
                 generate_subscripts({CONV_WORDS_SQL}, 1) AS pos FROM l),
    e AS (SELECT conv_id, turn, line, list(token_id ORDER BY pos) AS ids FROM t JOIN idx USING (term) GROUP BY 1, 2, 3)"""


@query(
    "prefix_sequences",
    f"""WITH {INDEX_SQL}, {LINES_SQL}, m AS (SELECT max(len(ids)) AS m FROM e),
        p AS (SELECT conv_id, turn, line, ids, unnest(range(2, len(ids) + 1)) AS k FROM e)
        SELECT conv_id, turn, CAST(line AS INTEGER) AS line, CAST(k AS INTEGER) AS k,
               trim(repeat('0 ', m - k) || array_to_string(ids[1:k - 1], ' ')) AS features, ids[k] AS target FROM p, m""",
)
def prefix_sequences(spark, sf):
    lines = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line", "text")
    )
    keys = ["conv_id", "turn", "line"]
    encoded = stage(textstats.encode_tokens(lines, keys, words(), conversation_index(spark, sf)))
    longest = encoded.agg(F.max(F.size("ids"))).scalar()
    prefixes = A.prefix_rows(encoded, keys, "ids")
    features, target = A.split_target(A.pad_left(F.col("p"), longest))
    return prefixes.select(
        *keys, F.size("p").alias("k"), F.array_join(features, " ").alias("features"), target.alias("target")
    )


NEXT_SQL = f"""w AS (SELECT {CONV_WORDS_SQL} AS w FROM conversations),
    b AS (SELECT unnest([w[i] FOR i IN range(1, len(w))]) AS prefix, unnest([w[i + 1] FOR i IN range(1, len(w))]) AS next FROM w),
    nx AS (SELECT prefix, next, count(*) AS n FROM b GROUP BY 1, 2
           QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY count(*) DESC, next) = 1)"""


@query("next_word", f"WITH {NEXT_SQL} SELECT prefix, next, n FROM nx")
def next_word(spark, sf):
    return textstats.next_word_table(table(spark, sf, "conversations"), words())


@query(
    "continue_text",
    f"""WITH {NEXT_SQL}, s AS (SELECT conv_id, turn, {CONV_WORDS_SQL}[-1] AS seed FROM conversations)
        SELECT conv_id, turn, concat_ws(' ', seed, a.next, b.next, c.next) AS continued
        FROM s LEFT JOIN nx a ON a.prefix = seed LEFT JOIN nx b ON b.prefix = coalesce(a.next, seed)
        LEFT JOIN nx c ON c.prefix = coalesce(b.next, a.next, seed) WHERE seed IS NOT NULL""",
)
def continue_text(spark, sf):
    conversations = table(spark, sf, "conversations")
    seeds = conversations.select("conv_id", "turn", F.try_element_at(words(), F.lit(-1)).alias("continued"))
    follow = textstats.next_word_table(conversations, words())
    return textstats.continue_text(seeds.where(F.col("continued").isNotNull()), "continued", follow, 3)


BACKOFF_SQL = " UNION ALL ".join(
    f"""SELECT {k} AS size, unnest([CASE WHEN {k} = 0 THEN '' ELSE array_to_string(w[i:i + {k} - 1], ' ') END FOR i IN range(1, len(w) - {k} + 1)]) AS context,
               unnest([w[i + {k}] FOR i IN range(1, len(w) - {k} + 1)]) AS next FROM c"""
    for k in range(4)
)


@query(
    "next_word_backoff",
    f"""WITH c AS (SELECT conv_id, turn, {CONV_WORDS_SQL} AS w FROM conversations),
        b AS (SELECT size, context, next FROM ({BACKOFF_SQL}) GROUP BY 1, 2, 3
              QUALIFY row_number() OVER (PARTITION BY size, context ORDER BY count(*) DESC, next) = 1),
        q AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
        a AS (SELECT item_id, k AS size, CASE WHEN k = 0 THEN '' ELSE array_to_string(w[len(w) - k + 1:], ' ') END AS context
              FROM q, range(4) r(k) WHERE k <= len(w))
        SELECT item_id, size::INT AS size, next FROM a JOIN b USING (size, context)
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY size DESC) = 1""",
)
def next_word_backoff(spark, sf):
    """The word after every benchmark text, by the longest context that the conversations know."""
    known = textstats.backoff_table(table(spark, sf, "conversations"), words(), 3)
    return textstats.backoff_next(table(spark, sf, "benchmark"), ["item_id"], words(), known, 3)


@query(
    "json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_field(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    "literal_list_names",
    """SELECT p_partkey, p_name || ', ' || p_type || '''s, ' || p_brand AS names FROM part""",
)
def literal_list_names(spark, sf):
    text = F.concat(
        F.lit("[{'id': "), F.col("p_size").cast("string"), F.lit(", 'name': '"), "p_name",
        F.lit("'}, {'id': None, 'name': \""), "p_type", F.lit("'s\"}, {'name': '"), "p_brand", F.lit("'}]"),
    )
    return table(spark, sf, "part").select("p_partkey", A.literal_list_field(text).alias("names"))


@query(
    "nested_explode",
    r"""SELECT role AS tag, 'pattern' AS kind, unnest(string_split(text, chr(10))) AS item FROM conversations
        UNION ALL SELECT role, 'response', unnest(string_split(text, '. ')) FROM conversations""",
)
def nested_explode(spark, sf):
    intents = table(spark, sf, "conversations").select(
        F.array(
            F.struct(
                F.col("role").alias("tag"),
                F.split("text", "\n").alias("patterns"),
                F.split("text", r"\. ").alias("responses"),
            )
        ).alias("intents")
    )
    flat = intents.select(F.explode("intents").alias("i"))
    patterns = flat.select("i.tag", F.lit("pattern").alias("kind"), F.explode("i.patterns").alias("item"))
    return patterns.union(flat.select("i.tag", F.lit("response"), F.explode("i.responses")))


SHARES_SQL = f"""t AS (SELECT conv_id, turn, unnest({CONV_WORDS_SQL}) AS term FROM conversations),
    s AS (SELECT conv_id, turn, count(*) FILTER (score > 0) / count(*) AS positive,
                 count(*) FILTER (score < 0) / count(*) AS negative,
                 count(*) FILTER (score IS NULL) / count(*) AS neutral
          FROM t LEFT JOIN {LEXICON_SQL} USING (term) GROUP BY 1, 2),
    r AS (SELECT conv_id, turn, positive, negative, neutral FROM conversations LEFT JOIN s USING (conv_id, turn))"""


def conversation_sentiment(spark, sf):
    lexicon = relational.literal_table(spark, ["term", "score"], list(LEXICON.items()))
    return textstats.lexicon_sentiment(table(spark, sf, "conversations"), ["conv_id", "turn"], words(), lexicon)


@query(
    "lexicon_sentiment",
    f"""WITH {SHARES_SQL} SELECT conv_id, turn, round(positive, 6) AS positive, round(negative, 6) AS negative,
        round(neutral, 6) AS neutral FROM r""",
)
def lexicon_sentiment(spark, sf):
    shares = conversation_sentiment(spark, sf)
    return shares.withColumns({c: F.round(c, 6) for c in ("positive", "negative", "neutral")})


@query(
    "sentiment_totals",
    f"""WITH {SHARES_SQL}, t2 AS (SELECT sum(positive) p, sum(negative) n, sum(neutral) u FROM r)
        SELECT round(p, 6) AS positive, round(n, 6) AS negative, round(u, 6) AS neutral,
               CASE WHEN p > n AND p > u THEN 'Positive' WHEN n > p AND n > u THEN 'Negative'
                    ELSE 'Neutral' END AS label FROM t2""",
)
def sentiment_totals(spark, sf):
    totals = textstats.sentiment_totals(conversation_sentiment(spark, sf))
    return totals.withColumns({c: F.round(c, 6) for c in ("positive", "negative", "neutral")})
