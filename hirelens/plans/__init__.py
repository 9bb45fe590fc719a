"""The warehouse layers as DataFrame functions, and the job that builds them."""
