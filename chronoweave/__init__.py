"""Multi-clock experiment recordings on Spark: event decoding, as-of alignment, session assembly and project state."""
