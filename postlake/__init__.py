"""postlake: Spark-native operators, checks and jobs for scraped posting records."""

from postlake.session import build_session, checkpoint, ensure_checkpoint_dir, ensure_library

__all__ = ["build_session", "checkpoint", "ensure_checkpoint_dir", "ensure_library"]
