from tessera.plans.facts import (load_table, line_facts, order_frame, event_frame,
                                 with_nulls, scored_frame)

__all__ = ["load_table", "line_facts", "order_frame", "event_frame", "with_nulls", "scored_frame"]
