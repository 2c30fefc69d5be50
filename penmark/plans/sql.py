"""SQL twins of the views and of the shared rules, for the checks."""

from __future__ import annotations

from penmark.functions.text import EMOJI, WS_CHARS

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
NOT_WS = r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def gone(text: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


def strip(text: str) -> str:
    return f"trim({text}, '{WS_CHARS}')"


def urls(text: str) -> str:
    return gone(text, f"http{NOT_WS}+")


def mentions(text: str) -> str:
    return gone(text, f"@{WORD}+")


def hashtags(text: str) -> str:
    return gone(text, f"#{WORD}+")


def emojis(text: str) -> str:
    return gone(text, EMOJI)


def spaces(text: str) -> str:
    return gone(strip(text), f"{WS}+", " ")


def cleaned(text: str) -> str:
    return f"coalesce(lower({spaces(emojis(hashtags(mentions(urls(text)))))}), '')"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda w: w <> '')"


def alpha(tokens: str) -> str:
    return f"list_filter({tokens}, lambda w: regexp_matches(w, '^[A-Za-z]+$'))"


def rounded(value: str, digits: int = 6) -> str:
    return f"(CASE WHEN round({value}, {digits}) = 0 THEN 0::DOUBLE ELSE round({value}, {digits}) END)"


def first_of(source: str, by: str, order: str, columns: str) -> str:
    """First row per ``by`` in ``order``."""
    return f"""SELECT {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


def encoded(source: str, vocab: str, keys: str) -> str:
    """``keys, ids`` of a table with ``text_id, tokens``."""
    return f"""
        SELECT {keys}, coalesce(e.ids, []) AS ids FROM {source} LEFT JOIN (
            SELECT x.text_id, list(CAST(coalesce(v.idx + 1, 0) AS INTEGER) ORDER BY x.k) AS ids
            FROM (SELECT text_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS k FROM {source}) x
            LEFT JOIN {vocab} v USING (word) GROUP BY x.text_id) e USING (text_id)"""


_TURN = "conv_id * 16777216 + turn"

# name -> (views it reads, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_posts": ((), """
        SELECT e.event_id AS pos, e.event_id AS text_id,
               CASE e.event_type WHEN 'error' THEN chr(160) || '  '
                                 WHEN 'view' THEN chr(8195) || ' ' || d.text || chr(10) ELSE d.text END AS text,
               e.user_id, CASE WHEN e.event_type <> 'click' THEN 0 END AS label, e.ts AS created_at
        FROM (SELECT *, event_id % (SELECT count(*) FROM documents) AS doc_id FROM events) e
        JOIN documents d USING (doc_id)"""),
    "raw_generated": ((), f"""
        SELECT {_TURN} AS pos, conv_id || ':' || turn AS text_id, text, CASE WHEN turn <> 1 THEN 1 END AS label
        FROM conversations WHERE role = 'assistant'"""),
    "user_turns": ((), f"""
        SELECT {_TURN} AS pos, text, 0 AS label FROM conversations WHERE role = 'user'"""),
    "human_corpus": ((), f"""
        SELECT {_TURN} AS pos, text, 0 AS label FROM conversations
        WHERE role = 'user' AND NOT regexp_matches(text, '[^\\x{{00}}-\\x{{ff}}]')"""),
    "labelled_corpus": ((), """
        SELECT doc_id AS pos, text, toxic AS label FROM documents JOIN labels USING (doc_id)"""),
    "posts": (("raw_posts",), f"""
        SELECT pos, sha1('twitter::' || text_id) AS text_id, text, user_id, coalesce(label, 0) AS label, created_at
        FROM ({first_of(f"(SELECT * REPLACE ({strip('text')} AS text) FROM raw_posts)", "text", "pos", "*")})
        WHERE length(text) > 0"""),
    "generated": (("raw_generated",), f"""
        SELECT pos, sha1('llm::' || text_id) AS text_id, text, coalesce(label, 1) AS label,
               NULL::VARCHAR AS prompt_name, NULL::VARCHAR AS model, 'llm' AS source
        FROM ({first_of(f"(SELECT * REPLACE ({strip('text')} AS text) FROM raw_generated)", "text", "pos", "*")})
        WHERE length(text) > 0"""),
    "main": (("posts", "generated", "human_corpus", "labelled_corpus"), """
        SELECT text, label, row_number() OVER (ORDER BY src_ord, pos) - 1 AS text_id FROM (
            SELECT text, label, pos, 0 AS src_ord FROM posts
            UNION ALL SELECT text, label, pos, 1 FROM generated
            UNION ALL SELECT text, label, pos, 2 FROM human_corpus
            UNION ALL SELECT text, label, pos, 3 FROM labelled_corpus)"""),
    "whole_main": (("posts", "generated", "user_turns", "labelled_corpus"), """
        SELECT text, label, row_number() OVER (ORDER BY src_ord, pos) - 1 AS text_id FROM (
            SELECT text, label, pos, 0 AS src_ord FROM posts
            UNION ALL SELECT text, label, pos, 1 FROM generated
            UNION ALL SELECT text, label, pos, 2 FROM user_turns
            UNION ALL SELECT text, label, pos, 3 FROM labelled_corpus)"""),
    "polar": ((), """
        SELECT doc_id, text, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS label, source FROM documents"""),
    "odd_labels": ((), """
        SELECT doc_id, text, CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 END AS label
        FROM documents"""),
    "tweety": (("polar",), """
        SELECT doc_id, label,
            '  @Bob_' || (length(text) % 50) || ' #Tag http://x.y/' || length(text) || ' 😀☕️ '
            || CASE WHEN length(text) % 7 = 0 THEN 'a' || chr(160) || 'b' ELSE '' END
            || CASE WHEN label = 1 AND length(text) % 3 = 0 THEN 'q§—q ' ELSE '' END
            || text || chr(9) || ' HTTP://Z ' AS text
        FROM polar UNION ALL SELECT -1 - doc_id, label, NULL FROM polar WHERE doc_id % 11 = 0"""),
    "tokens": (("polar",), f"""
        SELECT doc_id AS text_id, label, {alpha(words('text'))} AS tokens FROM polar"""),
    "turns": ((), f"SELECT {_TURN} AS text_id, text, role FROM conversations"),
    "vocab": (("tokens",), """
        SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS idx
        FROM (SELECT unnest(tokens) AS word FROM tokens) GROUP BY word"""),
    "full_vocab": (("tokens",), """
        SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS idx
        FROM (SELECT unnest(tokens) AS word FROM tokens) GROUP BY word"""),
    "encoded": (("tokens", "full_vocab"), encoded("tokens", "full_vocab", "text_id, label")),
    "logits": ((), """
        SELECT vec_id, label % 2 AS target, list_sum(CAST(embedding[1:32] AS DOUBLE[])) AS z0,
               list_sum(CAST(embedding[33:64] AS DOUBLE[])) AS z1 FROM embeddings"""),
    "softmax": (("logits",), """
        SELECT *, exp(z0 - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) AS p0,
                  exp(z1 - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) AS p1
        FROM logits"""),
    "requests": ((), f"""
        SELECT {_TURN} AS request_id, CASE role
            WHEN 'user' THEN CAST(json_object('texts', string_split(text || chr(10) || ' ' || chr(10) || 'end', chr(10))) AS VARCHAR)
            WHEN 'assistant' THEN CAST(json_object('text', text) AS VARCHAR)
            ELSE CASE length(text) % 5 WHEN 0 THEN text WHEN 1 THEN '{{"texts":[]}}' WHEN 2 THEN '{{"texts":"one"}}'
                 WHEN 3 THEN '{{}}' ELSE '{{"text":"   "}}' END END AS body
        FROM conversations"""),
    "batch_bodies": (("requests",), """
        SELECT request_id, CASE WHEN json_valid(body) AND json_type(body, '$.texts') = 'ARRAY'
            THEN CAST(json_extract(body, '$.texts') AS VARCHAR[]) ELSE [] END AS texts FROM requests"""),
    "batch_rows": (("batch_bodies",), """
        SELECT request_id, CAST(generate_subscripts(texts, 1) - 1 AS INTEGER) AS index, unnest(texts) AS text
        FROM batch_bodies"""),
    "model_files": ((), """
        SELECT 'model_save/' || event_id || '/' || CASE WHEN event_type = 'error' THEN 'run' || event_id || '.pt' ELSE
            CASE event_type WHEN 'click' THEN 'lstm' WHEN 'view' THEN 'rnn' ELSE 'bert' END || '_'
            || (tenths // 10) || '.' || (tenths % 10) || '_'
            || CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y') || '-13-' || strftime(ts, '%d_%H-%M-%S')
                    ELSE strftime(ts, '%Y-%m-%d_%H-%M-%S') END || '.pt' END AS path,
            event_id * 4096 + cents * 1000 AS size, ts AS modified
        FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents, CAST(round(value * 100) AS BIGINT) // 10 AS tenths
              FROM events)"""),
    "models": (("model_files",), r"""
        SELECT path, name, size, modified, round_even(size / 1048576.0::DOUBLE, 2) AS size_mb, parsed,
            CASE WHEN parsed THEN upper(kind) ELSE 'UNKNOWN' END AS model_type,
            CASE WHEN parsed THEN CAST(acc AS DOUBLE) ELSE 0::DOUBLE END AS accuracy,
            CASE WHEN parsed THEN stamp END AS timestamp,
            CASE WHEN NOT parsed THEN 'Unknown' WHEN stamp IS NOT NULL THEN strftime(stamp, '%Y-%m-%d %H:%M:%S')
                 ELSE day || ' ' || clock END AS formatted_time
        FROM (SELECT *, try_strptime(day || ' ' || replace(clock, '-', ':'), '%Y-%m-%d %H:%M:%S') AS stamp FROM (
            SELECT *, string_split(path, '/')[-1] AS name,
                regexp_matches(string_split(path, '/')[-1], '^([a-zA-Z]+)_(\d+\.?\d*)_(\d{4}-\d{2}-\d{2})_(\d{2}-\d{2}-\d{2})\.pt$') AS parsed,
                string_split(string_split(path, '/')[-1], '_')[1] AS kind,
                string_split(string_split(path, '/')[-1], '_')[2] AS acc,
                string_split(string_split(path, '/')[-1], '_')[3] AS day,
                replace(string_split(string_split(path, '/')[-1], '_')[4], '.pt', '') AS clock
            FROM model_files))"""),
    "batch_losses": ((), """
        SELECT event_type AS run, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch,
               value AS batch_loss, ts AS saved_at FROM events"""),
    "history": (("batch_losses",), """
        SELECT run, epoch, cents / (n * 100)::DOUBLE AS loss, cents / (n * 100)::DOUBLE / 100 AS val_acc, train_acc, saved_at
        FROM (SELECT run, epoch, CAST(sum(CAST(round(batch_loss * 100) AS BIGINT)) AS DOUBLE) AS cents, count(*) AS n,
                     avg(sqrt(batch_loss)) / 20 AS train_acc, max(saved_at) AS saved_at
              FROM batch_losses GROUP BY run, epoch)"""),
}


def with_views(body: str, *names: str) -> str:
    """A statement that defines the named views, and those they read, before ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in VIEWS[name][0]:
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in ordered) + " " + body
