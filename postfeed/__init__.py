"""postfeed: keep a published job-posting table in step with its source and publish it."""
