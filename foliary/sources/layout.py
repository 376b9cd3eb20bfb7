"""The layout engine: a converter with learned models, one per worker and setting. Its library is optional; the converter can be given."""

from __future__ import annotations

import io
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from foliary.sources import pdf

#: Variables that bound threads of numeric libraries, and devices.
THREADS = ("OMP_NUM_THREADS", "MKL_NUM_THREADS", "OPENBLAS_NUM_THREADS")
DEVICES = ("auto", "cpu", "cuda", "mps", "xpu")
DEVICE_NAME, SCALE = "FOLIARY_ACCELERATOR", 2.0


def thread_settings(threads: int, env: Mapping[str, str]) -> dict[str, str]:
    """What to add to the environment before the library is loaded; what is set already stays."""
    wanted = dict.fromkeys(THREADS, str(max(1, threads))) | {"TOKENIZERS_PARALLELISM": "false"}
    return {k: v for k, v in wanted.items() if k not in env}


def device(raw: str | None) -> str | None:
    """The device that is asked for; none if nothing is, or "auto", which is what the library does by itself."""
    name = (raw or "").strip().lower()
    if name and name not in DEVICES:
        raise ValueError(f"no device {name!r}; there are {', '.join(DEVICES)}")
    return None if name in ("", "auto") else name


def library_converter(ocr: bool, scale: float, pictures: bool) -> Callable[[bytes, tuple[int, int] | None], object]:
    """A function from bytes and a page range (from 1) to a document of the library. ImportError where it is not installed."""
    os.environ.update(thread_settings((os.cpu_count() or 2) // 4, os.environ))
    from docling.datamodel.accelerator_options import AcceleratorDevice, AcceleratorOptions
    from docling.datamodel.base_models import DocumentStream, InputFormat
    from docling.datamodel.pipeline_options import PdfPipelineOptions
    from docling.document_converter import DocumentConverter, PdfFormatOption

    options = PdfPipelineOptions(do_ocr=ocr, do_table_structure=True, generate_picture_images=pictures, images_scale=scale)
    if chosen := device(os.environ.get(DEVICE_NAME)):
        options.accelerator_options = AcceleratorOptions(device=AcceleratorDevice(chosen))
    converter = DocumentConverter(format_options={InputFormat.PDF: PdfFormatOption(pipeline_options=options)})

    def convert(content: bytes, pages: tuple[int, int] | None) -> object:
        more = {} if pages is None else {"page_range": pages}
        return converter.convert(DocumentStream(name="file.pdf", stream=io.BytesIO(content)), **more).document

    return convert


def pictures_of(document: object) -> list[bytes]:
    """The rendered pictures of a document as PNG; one that cannot be drawn is left out and never costs the text."""
    out = []
    for picture in getattr(document, "pictures", None) or ():
        image = getattr(picture, "image", None)
        image = getattr(image, "pil_image", image)
        try:
            buffer = io.BytesIO()
            image.save(buffer, format="PNG")
            out.append(buffer.getvalue())
        except Exception:
            continue
    return out


@dataclass
class LayoutEngine:
    """An engine for triage (ranges of pages) and for whole files. ``make`` gives a converter for a setting; each is made once."""

    make: Callable[[bool, float, bool], Callable[[bytes, tuple[int, int] | None], object]] = library_converter
    made: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"make": self.make, "made": {}}

    def _document(self, content: bytes, pages: tuple[int, int] | None, ocr: bool, scale: float | None, pictures: bool = False) -> object:
        setting = (ocr, SCALE if scale is None else scale, pictures)
        if setting not in self.made:
            self.made[setting] = self.make(*setting)
        return self.made[setting](content, pages)

    def __call__(self, content: bytes, first: int, last: int, ocr: bool, scale: float | None = None) -> list[str]:
        """Pages first to last, counted from 0, as one text; nothing if there is none."""
        said = self._document(content, (first + 1, last + 1), ocr, scale).export_to_markdown().strip()
        return [said] if said else []

    def whole(self, content: bytes) -> list[str]:
        said = self._document(content, None, True, None).export_to_markdown().strip()
        return [said] if said else []

    def with_pictures(self, content: bytes) -> tuple[str, list[bytes]]:
        document = self._document(content, None, True, None, True)
        return document.export_to_markdown().strip(), pictures_of(document)

    def register(self) -> None:
        pdf.register("layout", self.whole)
