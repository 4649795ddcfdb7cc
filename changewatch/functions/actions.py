"""The action dimension: which machine-written edit actions belong to which category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Action names by category.
ACTIONS: dict[str, list[str]] = {
    "claim": [
        "wbsetclaim", "wbsetclaim-create", "wbsetclaim-update", "wbsetclaimvalue",
        "wbcreateclaim-create", "wbcreateclaim-novalue", "wbcreateclaim-somevalue",
        "wbremoveclaims", "wbremoveclaims-remove", "wbsetclaim-update-rank",
        "wbsetstatementrank", "wbsetstatementrank-deprecated",
        "wbsetstatementrank-normal", "wbsetstatementrank-preferred",
    ],
    "qualifier": [
        "wbsetqualifier", "wbsetqualifier-add", "wbsetqualifier-update",
        "wbsetclaim-update-qualifiers", "wbremovequalifiers",
    ],
    "reference": [
        "wbsetreference", "wbsetreference-add", "wbsetclaim-update-references",
        "wbremovereferences", "wbremovereferences-remove",
    ],
    "sitelink": ["wbsetsitelink-add", "wbsetsitelink-remove", "wbsetsitelink-set"],
    "sitelinkmove": ["clientsitelink-update", "clientsitelink-remove"],
    "label": ["wbsetlabel-add", "wbsetlabel-remove", "wbsetlabel-set"],
    "description": ["wbsetdescription-add", "wbsetdescription-remove", "wbsetdescription-set"],
    "alias": ["wbsetaliases-add", "wbsetaliases-remove", "wbsetaliases-set", "wbsetaliases-update"],
    "anyterms": ["wbsetlabeldescriptionaliases"],
    "linktitles": ["wblinktitles-create", "wblinktitles-connect"],
    "editentity": [
        "wbeditentity-create", "wbeditentity-create-item", "wbeditentity-override",
        "wbeditentity-update", "wbeditentity-update-languages",
        "wbeditentity-update-languages-short", "wbeditentity-update-languages-and-other-short",
    ],
    "merge": ["wbmergeitems-to", "wbmergeitems-from", "wbcreateredirect"],
    "revert": ["undo", "restore"],
    "none": ["None"],
}

# Unions of categories that reports filter on.
UNIONS: dict[str, list[str]] = {
    "allclaims": ["claim", "qualifier", "reference"],
    "terms": ["label", "description", "alias", "anyterms"],
    "allsitelinks": ["sitelink", "sitelinkmove"],
}
TERM_CATEGORIES = UNIONS["terms"]
OTHER_CATEGORIES = ["editentity", "linktitles", "merge", "revert", "none"]
NO_CATEGORY = "NO_CAT"


def actions_of(*names: str) -> list[str]:
    """Action names of the given categories or unions, in map order."""
    return [action for name in names
            for category in UNIONS.get(name, [name])
            for action in ACTIONS[category]]


def category_of(action: Column) -> Column:
    """Category of an action; unknown and missing actions get ``NO_CAT``. Never null."""
    categories = F.create_map(*[
        F.lit(text) for category, names in ACTIONS.items() for name in names
        for text in (name, category)])
    return F.coalesce(F.element_at(categories, action), F.lit(NO_CATEGORY))


def action_map(spark: SparkSession) -> DataFrame:
    """One row per category or union with its actions as ``a, b, c``, in map order."""
    rows = [(i, name, ", ".join(actions_of(name)))
            for i, name in enumerate([*ACTIONS, *UNIONS])]
    return spark.createDataFrame(rows, "position int, category string, actions string")
