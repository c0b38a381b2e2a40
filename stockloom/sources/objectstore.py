"""Connector settings for an S3-compatible object store."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ObjectStore:
    endpoint: str
    access_key: str
    secret_key: str
    use_tls: bool = False
    committer: str = "directory"

    def spark_settings(self) -> dict[str, str]:
        """Settings to pass to ``SparkSession.builder.config``."""
        # Connector classes, time limits (milliseconds or seconds).
        s3a = {
            "endpoint": self.endpoint,
            "access.key": self.access_key,
            "secret.key": self.secret_key,
            "path.style.access": "true",
            "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "connection.ssl.enabled": str(self.use_tls).lower(),
            "aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
            "connection.establish.timeout": "5000",
            "connection.timeout": "10000",
            "socket.timeout": "10000",
            "threads.keepalivetime": "60",
            "committer.name": self.committer,
            "committer.magic.enabled": str(self.committer == "magic").lower(),
            "multipart.purge.age": "86400",
        }
        return {f"spark.hadoop.fs.s3a.{key}": value for key, value in s3a.items()}

    @staticmethod
    def root(bucket: str) -> str:
        return f"s3a://{bucket}"
