from tidemark.functions.predicates import cherry_pick, choose_predicate, everything, latest, strategy
from tidemark.functions.weeks import STORED_WEEK, WEEK, activity_frame, iso_week_key, orders_activity

__all__ = [
    "STORED_WEEK",
    "WEEK",
    "activity_frame",
    "cherry_pick",
    "choose_predicate",
    "everything",
    "iso_week_key",
    "latest",
    "orders_activity",
    "strategy",
]
