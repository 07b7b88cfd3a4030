from tidal.sources.tables import (action_records_from_events, actions_from_events, pairing_inputs,
                                  read_table, users_from_customer)
from tidal.sources.topics import (kafka_sink_options, kafka_source_options, read_json_topic,
                                  read_topic, write_json_topic, write_topic)

__all__ = ["action_records_from_events", "actions_from_events", "pairing_inputs", "read_table",
           "users_from_customer", "kafka_sink_options", "kafka_source_options", "read_json_topic",
           "read_topic", "write_json_topic", "write_topic"]
