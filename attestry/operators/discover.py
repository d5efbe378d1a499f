"""Documents listed in fetched registry payloads, response classes and the sync ledger."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.text import WHITESPACE

BODY_LIMIT = 2_000_000
IDENTITY = ("registry", "project_id", "discovered_at")
# The base of relative links and the download address of a document.
JSON_GROUPS_BASE = "https://registry.verra.org/"
DOWNLOAD_PREFIX = "https://assurance-platform.goldstandard.org/api/public/documents/"

_ANCHOR = r"(?is)<a(?=[\s>])([^>]*)>(.*?)(?=(</a\s*>|<a[\s>]|\z))"
_HREF = r"""(?is)(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
#: What a reference may be: a number, or a name whose last character may be a semicolon.
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)"
_LONGEST_BARE = max(len(name) for name in html5 if not name.endswith(";"))


def _numbered(code: Column) -> Column:
    """The character of a numeric reference, as HTML reads it.

    Numbers of the C1 range mean Windows characters; no character is U+FFFD, and controls and
    non-characters are left out.
    """
    windows = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    named = F.create_map(*[F.lit(x) for pair in windows.items() for x in pair])
    whole = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    low = F.pmod(code, F.lit(0x10000))
    left_out = (
        code.between(1, 8) | (code == 0x0B) | code.between(0x0E, 0x1F) | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF) | low.isin(0xFFFE, 0xFFFF)
    )
    return (
        F.when(code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd")
        .when(code.between(0x80, 0x9F), F.element_at(named, code.cast("int")))
        .when(left_out, "")
        .otherwise(whole)
    )


def unescape(text: Column) -> Column:
    """Character references replaced: numbers, and all names of HTML 5, also those without semicolon."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")

    def after_ampersand(piece: Column) -> Column:
        reference = F.regexp_extract(piece, _REFERENCE, 1)
        digits = F.regexp_extract(piece, r"^#[xX]?([0-9a-fA-F]+)", 1)
        hexadecimal = piece.rlike("^#[xX]")
        short = F.length(F.ltrim(digits, F.lit("0"))) <= 8
        code = F.when(short, F.conv(digits, 16, 10)).cast("long")
        code = F.when(hexadecimal, code).otherwise(digits.try_cast("long"))
        rest = F.substr(piece, F.length(reference) + 1)
        # The whole name, or else the longest bare one that it begins with: those may run on.
        length = F.length(reference)
        sizes = F.array_append(
            F.filter(F.array(*[F.lit(n) for n in range(_LONGEST_BARE, 1, -1)]), lambda n: n < length), F.lit(0)
        )
        tried = F.transform(
            F.concat(F.array(length), sizes),
            lambda n: F.struct(n.alias("n"), F.element_at(names, F.substr(piece, F.lit(1), n)).alias("character")),
        )
        found = F.get(F.filter(tried, lambda x: x["character"].isNotNull()), F.lit(0))
        return (
            F.when(reference == "", F.concat(F.lit("&"), piece))
            .when(reference.startswith("#"), F.concat(_numbered(code), rest))
            .when(found.isNotNull(), F.concat(found["character"], F.substr(piece, found["n"] + 1)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    pieces = F.split(text, "&", -1)
    read = F.transform(pieces, lambda piece, at: F.when(at == 0, piece).otherwise(after_ampersand(piece)))
    return F.when(text.contains("&"), F.array_join(read, "")).otherwise(text)


def join_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found at ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    plain = F.regexp_replace(base, r"[?#].*$", "")
    has_path = plain.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/")
    folder = F.when(has_path, F.regexp_replace(plain, "[^/]*$", "")).otherwise(
        F.concat(plain, F.lit("/"))
    )
    path = F.concat(folder, link)
    tidy = _resolve_dots(path)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link == "", base)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), _resolve_dots(F.concat(origin, link)))
        .when(link.startswith("?"), F.concat(plain, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), link))
        .otherwise(tidy)
    )


def _resolve_dots(url: Column) -> Column:
    """Resolve ``.`` and ``..`` in the path of an absolute URL."""
    origin = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    rest = F.substr(url, F.length(origin) + 1)
    tail = F.regexp_extract(rest, r"([?#].*)$", 1)
    segments = F.split(F.substr(rest, F.lit(1), F.length(rest) - F.length(tail)), "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when((part == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
        .when(part == "..", acc)
        .otherwise(F.concat(acc, F.array(part))),
    )
    resolved = F.concat(origin, F.array_join(kept, "/"), tail)
    return F.when(rest.contains("/."), resolved).otherwise(url)


def html_links(payloads: DataFrame, pattern: str = ".pdf") -> DataFrame:
    """Documents behind anchors whose address or label contains ``pattern``.

    Ids count all anchors of the page, so a changed filter does not renumber documents. Everything
    happens inside the payload's row; only matching links leave it.
    """
    def anchor(i: Column) -> Column:
        inner = F.regexp_replace(F.element_at("_labels", i), "(?s)(?:<[^>]*>)+", " ")
        return F.struct(
            _href(F.element_at("_attributes", i)).alias("href"),
            F.trim(unescape(inner), F.lit(WHITESPACE)).alias("label"),
            F.element_at("_ends", i).startswith("</").alias("closed"),
        )

    # An anchor that is never closed or has no address is no link and takes no number.
    every = F.transform(F.sequence(F.lit(1), F.size("_attributes")), anchor)
    real = F.filter(every, lambda a: a["closed"] & (F.length(a["href"]) > 0))
    body = F.regexp_replace("body", r"(?is)<!--.*?-->|<(script|style)[^>]*>.*?</\1\s*>", "")
    groups = {"_attributes": 1, "_labels": 2, "_ends": 3}
    found = (
        payloads.withColumn("_body", body)
        .withColumns(
            {
                name: F.regexp_extract_all("_body", F.lit(_ANCHOR), F.lit(group))
                for name, group in groups.items()
            }
        )
        .where(F.size("_attributes") > 0)
        .select(*IDENTITY, "url", F.posexplode_outer(real).alias("_at", "a"))
        .where("a IS NOT NULL")
    )
    href, label = F.col("a.href"), F.col("a.label")
    wanted = F.lower(href).contains(pattern) | F.lower(label).contains(pattern)
    return found.where(wanted).select(
        "registry",
        "project_id",
        F.concat_ws("-", "registry", "project_id", F.col("_at") + 1).alias("document_id"),
        F.lit("other").alias("document_type"),
        F.when(label != "", label).otherwise(F.element_at(F.split(href, "/"), -1)).alias("title"),
        join_url(F.col("url"), href).alias("url"),
        "discovered_at",
        F.lit(None).cast("string").alias("declared_version"),
    )


def _href(attributes: Column) -> Column:
    parts = [F.regexp_extract(attributes, _HREF, n) for n in (1, 2, 3)]
    return unescape(F.concat(*parts))


_GROUPS = (
    "documentGroups array<struct<documents:array<struct<"
    "id:string,uri:string,documentName:string,version:string>>>>"
)
_REQUESTS = "requests array<struct<documents:array<struct<id:string,name:string>>>>"


def verra_documents(payloads: DataFrame) -> DataFrame:
    """Documents of ``documentGroups[].documents[]``; entries without an address are skipped."""
    items = (
        payloads.withColumn("_p", F.from_json("body", _GROUPS))
        .select(*IDENTITY, F.explode("_p.documentGroups").alias("_g"))
        .select(*IDENTITY, F.explode("_g.documents").alias("d"))
        .where("d.uri IS NOT NULL AND d.uri != ''")
    )

    def filled(column: Column) -> Column:
        return F.when(column != "", column)

    document = F.coalesce(filled(F.col("d.id")), F.col("d.uri"))
    return items.select(
        "registry",
        "project_id",
        document.alias("document_id"),
        F.lit("other").alias("document_type"),
        F.coalesce(filled(F.col("d.documentName")), document).alias("title"),
        join_url(F.lit(JSON_GROUPS_BASE), F.col("d.uri")).alias("url"),
        "discovered_at",
        F.col("d.version").alias("declared_version"),
    )


def gold_standard_documents(payloads: DataFrame) -> DataFrame:
    """Documents of ``requests[].documents[]``; entries without an id are skipped."""
    items = (
        payloads.withColumn("_p", F.from_json("body", _REQUESTS))
        .select(*IDENTITY, F.explode("_p.requests").alias("_r"))
        .select(*IDENTITY, F.explode("_r.documents").alias("d"))
        .where("d.id IS NOT NULL")
    )
    named = F.when(F.col("d.name") != "", F.col("d.name"))
    return items.select(
        "registry",
        "project_id",
        F.col("d.id").alias("document_id"),
        F.lit("other").alias("document_type"),
        F.coalesce(named, F.col("d.id")).alias("title"),
        F.concat(F.lit(DOWNLOAD_PREFIX), F.col("d.id"), F.lit("/download")).alias("url"),
        "discovered_at",
        F.lit(None).cast("string").alias("declared_version"),
    )


def classify_responses(responses: DataFrame) -> DataFrame:
    """Add status, error_code and body_bytes to fetched responses (http_status, content_type, body).

    A row without an http_status stands for a failed transport.
    """
    code = F.col("http_status")
    kind = F.trim(F.substring_index(F.lower(F.coalesce("content_type", F.lit(""))), ";", 1))
    size = F.coalesce(F.octet_length("body"), F.lit(0))
    page = F.lower("body")
    lost = page.contains("invalid page") | page.contains("404 not found")
    http = F.concat(F.lit("http_"), code)
    html = kind.isin("text/html", "application/xhtml+xml")
    valid_json = F.expr("try_parse_json(body) IS NOT NULL")
    ok_range = code.between(200, 299)
    ladder = [
        (code.isNull(), "transport_failure", F.lit("network_error")),
        (ok_range & (size > BODY_LIMIT), "endpoint_mismatch", F.lit("response_too_large")),
        (code == 403, "blocked", http),
        (code == 404, "not_found", http),
        (code == 429, "rate_limited", http),
        (code >= 500, "transient_failure", http),
        (~ok_range, "blocked", http),
        ((kind == "application/json") & valid_json, "ok", F.lit(None).cast("string")),
        (kind == "application/json", "endpoint_mismatch", F.lit("invalid_json")),
        (html & lost, "not_found", F.lit("html_not_found")),
        (html, "endpoint_mismatch", F.lit("html_instead_of_data")),
    ]
    status = F.when(ladder[0][0], ladder[0][1])
    error = F.when(ladder[0][0], ladder[0][2])
    for condition, name, reason in ladder[1:]:
        status, error = status.when(condition, name), error.when(condition, reason)
    return responses.withColumns(
        {
            "status": status.otherwise("endpoint_mismatch"),
            "error_code": error.otherwise("unexpected_content_type"),
            "body_bytes": size,
        }
    )


def run_status(failures: DataFrame, runs: DataFrame) -> DataFrame:
    """Status and next cursor of every sync run.

    ``runs`` has (sync_run_id, registry, cursor_before, next_cursor, discovered_projects,
    finished_at); ``failures`` has (sync_run_id, scope). A run with any failure keeps its cursor.
    """
    failed = failures.groupBy("sync_run_id").agg(
        F.count(F.lit(1)).alias("failures"),
        F.max(F.col("scope") == "registry").alias("_registry"),
    )
    count = F.coalesce("failures", F.lit(0))
    return runs.join(failed, "sync_run_id", "left").select(
        *runs.columns,
        count.alias("failures"),
        F.when(count == 0, "succeeded")
        .when(F.col("_registry"), "failed")
        .when(F.col("discovered_projects") > 0, "partial")
        .otherwise("failed")
        .alias("status"),
        F.when(count == 0, F.col("next_cursor")).otherwise(F.col("cursor_before")).alias(
            "cursor_after"
        ),
    )


def sync_ledger(runs: DataFrame) -> DataFrame:
    """Latest run and standing cursor per registry, as one partial aggregate."""
    order = F.struct("finished_at", "sync_run_id")
    return runs.groupBy("registry").agg(
        F.max_by("sync_run_id", order).alias("last_run_id"),
        F.max_by("status", order).alias("last_status"),
        F.max_by("cursor_after", order).alias("cursor"),
        F.max("finished_at").alias("updated_at"),
        F.count(F.lit(1)).alias("runs"),
    )
