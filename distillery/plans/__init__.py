"""End-to-end plans (pipelines), the registered query catalog and plan inspection."""
