"""The jobs as micro-batch streams. Output is keyed by batch id, so a replayed batch replaces itself."""
