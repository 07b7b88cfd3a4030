from tidal.operators.join import user_action_join, user_action_join_sql
from tidal.operators.pairing import pair_tagged, pair_user_action
from tidal.operators.rules import rule_filter, rule_filter_single
from tidal.operators.views import conform, project_action, project_user, register_views

__all__ = ["user_action_join", "user_action_join_sql", "pair_user_action", "pair_tagged",
           "rule_filter", "rule_filter_single", "conform", "project_action",
           "project_user", "register_views"]
