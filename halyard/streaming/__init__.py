from halyard.streaming.scoring import promoted_scorer, score_stream, score_stream_promoted

__all__ = ["promoted_scorer", "score_stream", "score_stream_promoted"]
