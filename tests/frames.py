"""Rows of events, and frames as lists of dicts, for the tests."""


def push(repo, actor, size=1, ts="2025-01-06 10:00:00", era="2025-Q1", **more):
    return dict(
        event_id="x", event_type="PushEvent", repo_name=repo, actor_login=actor, event_ts=ts,
        push_distinct_size=size, era=era, **more,
    )


def star(repo, actor="a", ts="2025-01-06 10:00:00", era="2025-Q1"):
    return dict(event_id="x", event_type="WatchEvent", repo_name=repo, actor_login=actor, event_ts=ts, era=era)


def pr(repo, number, action, merged=None, actor="a", ts="2025-01-06 10:00:00", era="2025-Q1"):
    return dict(
        event_id="x", event_type="PullRequestEvent", repo_name=repo, actor_login=actor, event_ts=ts,
        payload_action=action, pr_number=number, pr_merged=merged, era=era,
    )


def rows(df, *order):
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((r[c] is not None, r[c]) for c in order)) if order else out
