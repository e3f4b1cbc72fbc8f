"""Small frames for tests."""

from datetime import datetime

ONBOARDING = (
    "user_id string, first_login_dt timestamp_ntz, habito int, activacion int,"
    " setup int, return_flag int"
)
TRANSACTIONS = "user_id string, transaction_dt timestamp_ntz, type int"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *names):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*names) if names else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def by_user(df):
    return {r["user_id"]: r.asDict() for r in df.collect()}
