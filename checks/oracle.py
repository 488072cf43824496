"""All checking SQL by query key."""

from checks import business, cleaning, featuresql, modelsql

SQL: dict[str, str] = {**business.SQL, **cleaning.SQL, **featuresql.SQL, **modelsql.SQL}
