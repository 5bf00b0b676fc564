"""Small synthetic credit tables with known relations between them."""

from __future__ import annotations

import numpy as np
import pandas as pd

from riskloom.sources import contracts as c


def applications(n: int = 400, seed: int = 0, first_key: int = 100001, income_scale: float = 1e5) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({
        "SK_ID_CURR": np.arange(first_key, first_key + n),
        "AMT_INCOME_TOTAL": rng.exponential(income_scale, n).round(2) + 1,
        "AMT_CREDIT": rng.exponential(3e5, n).round(2) + 1,
        "AMT_ANNUITY": rng.exponential(2e4, n).round(2) + 1,
        "AMT_GOODS_PRICE": rng.exponential(3e5, n).round(2) + 1,
        "DAYS_BIRTH": -rng.integers(7000, 25000, n),
        "DAYS_EMPLOYED": -rng.integers(1, 9000, n),
        "DAYS_REGISTRATION": -rng.integers(1, 9000, n).astype(float),
        "DAYS_ID_PUBLISH": -rng.integers(1, 6000, n),
        "OWN_CAR_AGE": np.where(rng.random(n) < 0.5, np.nan, rng.integers(0, 30, n).astype(float)),
        "CNT_CHILDREN": rng.integers(0, 4, n),
        "FLAG_OWN_CAR": rng.choice(["Y", "N"], n),
        **{f"EXT_SOURCE_{i}": rng.random(n) for i in (1, 2, 3)},
        **{
            name: rng.choice(c.DOMAINS[name][:4], n)
            for name in ("CODE_GENDER", "NAME_CONTRACT_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
                         "NAME_INCOME_TYPE", "ORGANIZATION_TYPE")
        },
    })
    frame.loc[::17, "DAYS_EMPLOYED"] = 365243
    risk = 2.5 * (0.5 - frame.EXT_SOURCE_2) + 2.5 * (0.5 - frame.EXT_SOURCE_3) - 0.8
    frame["TARGET"] = (rng.random(n) < 1 / (1 + np.exp(-risk))).astype(int)
    return frame


def history(keys, seed: int = 1) -> dict[str, pd.DataFrame]:
    rng = np.random.default_rng(seed)
    keys = np.asarray(keys)

    def owners(k):
        return rng.choice(keys, k)

    n = len(keys) * 3
    bureau = pd.DataFrame({
        "SK_ID_CURR": owners(n),
        "SK_ID_BUREAU": np.arange(n),
        "DAYS_CREDIT": -rng.integers(1, 3000, n),
        "CREDIT_DAY_OVERDUE": rng.integers(0, 3, n),
        "DAYS_CREDIT_ENDDATE": np.where(rng.random(n) < 0.2, np.nan, rng.integers(-1000, 1000, n)),
        "AMT_CREDIT_MAX_OVERDUE": np.where(rng.random(n) < 0.6, np.nan, rng.random(n) * 100),
        "AMT_CREDIT_SUM": rng.random(n) * 1e5,
        "AMT_CREDIT_SUM_DEBT": rng.random(n) * 1e4,
        "AMT_CREDIT_SUM_OVERDUE": rng.random(n),
        "DAYS_CREDIT_UPDATE": -rng.integers(1, 100, n),
        "AMT_ANNUITY": np.where(rng.random(n) < 0.5, np.nan, rng.random(n) * 1e3),
        "CREDIT_ACTIVE": rng.choice(["Active", "Closed", None], n, p=[0.4, 0.5, 0.1]),
        "CREDIT_TYPE": rng.choice(["Credit card", "Car loan"], n),
    })
    m = n * 2
    balance = pd.DataFrame({
        "SK_ID_BUREAU": rng.integers(0, n, m),
        "MONTHS_BALANCE": -rng.integers(0, 40, m),
        "STATUS": rng.choice(c.STATUS_LEVELS, m),
    })
    instalments = pd.DataFrame({
        "SK_ID_CURR": owners(m),
        "NUM_INSTALMENT_VERSION": rng.integers(0, 4, m).astype(float),
        "AMT_INSTALMENT": np.where(rng.random(m) < 0.1, 0.0, rng.random(m) * 100),
        "AMT_PAYMENT": rng.random(m) * 100,
    })
    pos = pd.DataFrame({
        "SK_ID_CURR": owners(n)[: n // 2],
        "MONTHS_BALANCE": -rng.integers(0, 40, n // 2),
        "SK_DPD": rng.integers(0, 5, n // 2),
        "CNT_INSTALMENT_FUTURE": np.where(rng.random(n // 2) < 0.2, np.nan, rng.integers(0, 30, n // 2)),
    })
    card = pd.DataFrame({
        "SK_ID_CURR": rng.choice(keys[: len(keys) // 4], n // 3),
        "AMT_BALANCE": rng.random(n // 3) * 1e4,
        "AMT_CREDIT_LIMIT_ACTUAL": rng.integers(0, 10, n // 3) * 1000,
        "AMT_DRAWINGS_CURRENT": rng.random(n // 3),
        "CNT_INSTALMENT_MATURE_CUM": rng.integers(0, 30, n // 3).astype(float),
        "SK_DPD": rng.integers(0, 5, n // 3),
    })
    previous = pd.DataFrame({
        "SK_ID_CURR": owners(n),
        "AMT_ANNUITY": rng.random(n) * 1e3,
        "AMT_CREDIT": rng.random(n) * 1e5,
        "AMT_GOODS_PRICE": np.where(rng.random(n) < 0.2, np.nan, rng.random(n) * 1e5),
        "CNT_PAYMENT": rng.integers(6, 60, n).astype(float),
        "DAYS_DECISION": -rng.integers(1, 3000, n),
        "NAME_CONTRACT_STATUS": rng.choice(["Approved", "Refused", "Unused offer"], n),
        "NAME_YIELD_GROUP": rng.choice(["high", "low_normal", "XNA"], n),
    })
    return {
        "bureau": bureau, "bureau_balance": balance, "installments_payments": instalments,
        "POS_CASH_balance": pos, "credit_card_balance": card, "previous_application": previous,
    }


def to_spark(spark, frame: pd.DataFrame):
    """Spark table with NaN and None as NULL."""
    from riskloom.functions.scalars import normalise_missing

    return normalise_missing(spark.createDataFrame(frame))
