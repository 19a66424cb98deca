"""DataFrame-to-DataFrame operators; none of them starts a job unless its name says ``count``."""
