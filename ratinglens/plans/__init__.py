"""End-to-end plans: building the views and reading them back."""
