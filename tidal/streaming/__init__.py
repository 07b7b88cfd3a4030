from tidal.streaming.pairing import PairingProcessor, pair_tagged_stream, pair_user_action_stream
from tidal.streaming.rules import RuleGateProcessor, rule_filter_microbatch, rule_filter_stream
from tidal.streaming.runner import run_stream, run_to_table, tap

__all__ = ["PairingProcessor", "pair_user_action_stream", "pair_tagged_stream",
           "RuleGateProcessor", "rule_filter_stream", "rule_filter_microbatch", "run_stream",
           "run_to_table", "tap"]
