"""Derived Silver features: payload fields, activity category, time of day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
#
# Activity category: the first rule whose substrings occur in event_type
# (case-sensitive) wins; no match gives "other".
CATEGORY_RULES = (
    (("Push", "Commit"), "code_change"),
    (("PullRequest", "Review"), "code_review"),
    (("Issue",), "issue_management"),
    (("Create", "Delete"), "repository_admin"),
)
OTHER_CATEGORY = "other"
# Event types that count as an active contribution.
ACTIVE_TYPES = ("PushEvent", "PullRequestEvent", "IssuesEvent", "CommitCommentEvent")
# Time of day by hour: [6,12) morning, [12,18) afternoon, [18,24) evening,
# anything else (including a missing hour, read as 0) night.
TIME_OF_DAY = (("morning", 6, 12), ("afternoon", 12, 18), ("evening", 18, 24))
NIGHT = "night"
TIME_OF_DAY_ORDER = ("morning", "afternoon", "evening", "night")
# Default event-type allow-list of the reference configuration.
DEFAULT_TYPE_FILTER = ("PushEvent", "PullRequestEvent", "IssuesEvent", "WatchEvent", "ForkEvent")
# ---------------------------------------------------------------------------


def activity_category(event_type: Column | str) -> Column:
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for needles, label in CATEGORY_RULES:
        cond = None
        for needle in needles:
            c = F.coalesce(et.contains(needle), F.lit(False))
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(OTHER_CATEGORY)


def is_active_contribution(event_type: Column | str) -> Column:
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.coalesce(et.isin(*ACTIVE_TYPES), F.lit(False))


def time_of_day(hour: Column | str) -> Column:
    h = F.coalesce(F.col(hour) if isinstance(hour, str) else hour, F.lit(0))
    expr = None
    for label, lo, hi in TIME_OF_DAY:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(NIGHT)


def time_of_day_rank(label: Column | str) -> Column:
    """Position of a time-of-day label in its natural order (1-based)."""
    lab = F.col(label) if isinstance(label, str) else label
    return F.array_position(F.array(*[F.lit(x) for x in TIME_OF_DAY_ORDER]), lab)


def _get(payload: Column, path: str, type_: str) -> Column:
    # try_variant_get: NULL for an absent path, a JSON null or a type mismatch.
    return F.try_variant_get(payload, path, type_)


def payload_features(event_type: Column | str, payload: Column | str) -> dict[str, Column]:
    """Typed features from the Variant payload; NULL when the type does not match.

    Defaults apply both to absent keys and to explicit nulls.
    """
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    p = F.col(payload) if isinstance(payload, str) else payload
    is_push = et == F.lit("PushEvent")
    is_pr = et == F.lit("PullRequestEvent")
    is_issue = et == F.lit("IssuesEvent")
    is_watch = et == F.lit("WatchEvent")
    labels = F.transform(
        _get(p, "$.issue.labels", "array<struct<name:string>>"), lambda l: l["name"])
    return {
        "push_size": F.when(is_push, F.coalesce(_get(p, "$.size", "int"), F.lit(0))),
        "push_ref": F.when(is_push, F.coalesce(_get(p, "$.ref", "string"), F.lit(""))),
        "push_commits_count": F.when(
            is_push, F.coalesce(F.array_size(_get(p, "$.commits", "array<variant>")), F.lit(0))),
        "pr_action": F.when(is_pr, _get(p, "$.action", "string")),
        "pr_state": F.when(is_pr, _get(p, "$.pull_request.state", "string")),
        "pr_merged": F.when(is_pr, F.coalesce(_get(p, "$.pull_request.merged", "boolean"), F.lit(False))),
        "pr_additions": F.when(is_pr, F.coalesce(_get(p, "$.pull_request.additions", "int"), F.lit(0))),
        "pr_deletions": F.when(is_pr, F.coalesce(_get(p, "$.pull_request.deletions", "int"), F.lit(0))),
        "issue_action": F.when(is_issue, _get(p, "$.action", "string")),
        "issue_state": F.when(is_issue, _get(p, "$.issue.state", "string")),
        "issue_labels": F.when(
            is_issue, F.coalesce(labels, F.array().cast("array<string>"))),
        "watch_action": F.when(is_watch, _get(p, "$.action", "string")),
    }
