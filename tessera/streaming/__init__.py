from tessera.streaming.scoring import (first_by_key, rows_behind, score_stream, start_deduplicated_scoring,
                                       start_scoring_stream)

__all__ = ["first_by_key", "rows_behind", "score_stream", "start_deduplicated_scoring", "start_scoring_stream"]
